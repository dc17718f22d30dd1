"""Incremental runs as structured streams."""
