"""Gridded-climate analytics on Spark: a daily cube is a long table keyed by (cell, day)."""

__version__ = "0.1.0"
