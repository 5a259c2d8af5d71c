"""Incremental flows on Structured Streaming."""
