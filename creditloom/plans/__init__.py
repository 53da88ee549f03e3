"""Whole queries: from source DataFrames to a result DataFrame."""
