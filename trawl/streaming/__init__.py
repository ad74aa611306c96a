"""Structured Streaming: incremental index ingest and running crawl statistics."""
