"""Operators: DataFrames to DataFrames."""
