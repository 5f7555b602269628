"""Part of tessella: streaming."""
