"""Operators on canonical tables: DataFrames in, DataFrames out."""
