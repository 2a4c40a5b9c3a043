"""Structured Streaming forms of the batch operators, for snapshot files that keep arriving."""
