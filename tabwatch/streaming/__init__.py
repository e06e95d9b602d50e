"""Structured Streaming operators: stream scoring and drift per batch/window."""
