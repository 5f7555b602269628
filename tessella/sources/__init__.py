"""Part of tessella: sources."""
