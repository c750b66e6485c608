"""Structured Streaming queries over social posts."""
