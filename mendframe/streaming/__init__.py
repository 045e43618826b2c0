"""Structured Streaming form of the health checks."""
