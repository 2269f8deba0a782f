"""Incremental ingestion of arriving files with Structured Streaming."""
