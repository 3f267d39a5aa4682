"""Incremental (Structured Streaming) ingest and curation."""
