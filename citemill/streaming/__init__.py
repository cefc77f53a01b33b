"""Structured Streaming versions of the ingest and filter jobs."""
