"""Operators that are more than one Spark call."""
