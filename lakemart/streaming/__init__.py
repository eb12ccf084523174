"""Incremental bronze ingestion with Structured Streaming."""
