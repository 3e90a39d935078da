"""Relational operators: each one maps DataFrames to a DataFrame."""
