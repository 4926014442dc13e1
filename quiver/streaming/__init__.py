"""Structured Streaming scoring and running top-k."""
