"""Incremental ingestion of new log files with Structured Streaming."""
