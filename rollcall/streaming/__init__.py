"""Incremental scoring."""
