"""Structured Streaming forms of the change and milestone operators."""
