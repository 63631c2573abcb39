"""Incremental loading with Structured Streaming's file source."""
