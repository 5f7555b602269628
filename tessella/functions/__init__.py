"""Part of tessella: functions."""
