"""Structured Streaming flows over the same operators."""
