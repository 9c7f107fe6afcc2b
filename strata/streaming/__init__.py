"""Structured Streaming: the live windowed aggregation and stream utilities."""
