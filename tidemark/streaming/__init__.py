"""Structured Streaming forms of incremental collection."""
