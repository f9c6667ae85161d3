"""Structured Streaming forms of the merges and monitors."""
