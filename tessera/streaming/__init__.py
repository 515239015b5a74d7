"""Structured Streaming entry points (fitted, stateless stages on a stream)."""
