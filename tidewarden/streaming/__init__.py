"""Incremental runs over overlapping windows."""
