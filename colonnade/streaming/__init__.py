"""Structured Streaming sources and sinks for cell tables."""
