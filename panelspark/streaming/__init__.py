"""Incremental runs of the ingestion rules on Structured Streaming."""
