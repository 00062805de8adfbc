"""Structured Streaming jobs; every window function also runs on batch DataFrames."""
