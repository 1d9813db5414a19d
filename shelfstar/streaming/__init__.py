"""Incremental event processing with Structured Streaming."""
