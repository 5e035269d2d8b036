"""Incremental runs as a Structured Streaming query."""
