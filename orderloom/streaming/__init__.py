"""Structured Streaming: loading newly arrived files, and deduplicating re-delivered rows."""
