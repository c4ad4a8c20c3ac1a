"""Structured Streaming forms of ingest and of the event reports."""
