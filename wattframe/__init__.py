"""Spark analytics for quarter-hour power-system series."""
