"""Structured Streaming jobs; every windowed aggregation also runs on a batch DataFrame."""
