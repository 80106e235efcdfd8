"""Windowed sales aggregates on Structured Streaming."""
