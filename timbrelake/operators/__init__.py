"""Operators: every function takes and returns DataFrames, with column names as parameters."""
