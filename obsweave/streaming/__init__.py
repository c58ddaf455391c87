"""Structured Streaming: windows, upserts, live state, counters."""
