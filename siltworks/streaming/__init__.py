"""Structured Streaming variants (extensions)."""
