"""Folder ingest and running statistics with Structured Streaming."""
