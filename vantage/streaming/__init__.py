"""Structured Streaming forms of queries whose state is bounded by event time."""
