"""Operators: DataFrames in, lazy DataFrames out. None of them runs a job by itself."""
