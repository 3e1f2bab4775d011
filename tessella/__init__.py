"""Glyph analytics over post streams, on Spark."""
