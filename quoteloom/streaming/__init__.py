"""Structured Streaming twins of the live operators."""
