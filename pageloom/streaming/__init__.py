"""Incremental operation on Structured Streaming."""
