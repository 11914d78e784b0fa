"""Structured Streaming: exactly-once ingest of raw feed drops."""
