"""Tesserae: a Spark-native engine for building and curating document corpora."""
