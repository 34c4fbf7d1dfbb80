"""Operators: every function maps DataFrames to a DataFrame; none collects."""
