"""Structured Streaming sources, sinks and jobs."""
