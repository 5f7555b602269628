"""Part of tessella: operators."""
