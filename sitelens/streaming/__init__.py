"""Streaming forms (Structured Streaming, availableNow triggers)."""
