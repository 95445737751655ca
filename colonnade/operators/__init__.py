"""Operators over cell form and mutation logs: DataFrames in, DataFrames out."""
