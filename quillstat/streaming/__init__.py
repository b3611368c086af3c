"""Structured Streaming forms of the admission, scoring and monitoring jobs."""
