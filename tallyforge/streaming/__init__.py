"""Structured Streaming sources, projections and sinks."""
