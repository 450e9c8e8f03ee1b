"""Incremental forms."""
