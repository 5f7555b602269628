"""Part of tessella: plans."""
