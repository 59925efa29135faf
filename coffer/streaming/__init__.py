"""Structured Streaming forms of the incremental and alert jobs."""
