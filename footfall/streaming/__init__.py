"""Structured Streaming: message ingest and hourly counts."""
