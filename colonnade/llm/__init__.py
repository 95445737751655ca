"""Operators of a training-data pipeline: language, line and passage cleaning, deduplication, scoring, tokens."""
