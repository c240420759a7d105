"""Incremental processing of arrivals with Structured Streaming."""
