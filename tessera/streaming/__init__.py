"""Structured Streaming versions of the row-local and windowed operators."""
