"""Incremental forms of the counts."""
