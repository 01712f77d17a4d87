"""Operators: each takes DataFrames and keyword thresholds and returns a DataFrame."""
