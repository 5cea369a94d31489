"""Structured Streaming forms of the operators and jobs."""
