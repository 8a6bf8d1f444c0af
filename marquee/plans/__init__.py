"""Models built from the operators: marts and the daily batch."""
