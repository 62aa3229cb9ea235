"""Streaming forms of the monthly composites."""
