"""Relational operators over document corpora."""
