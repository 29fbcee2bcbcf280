"""Structured Streaming forms of the upkeep jobs."""
