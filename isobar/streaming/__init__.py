"""Structured Streaming versions of the hourly jobs."""
