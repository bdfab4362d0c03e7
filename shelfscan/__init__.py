"""Retail sales analytics on Spark: landing, fact loading, dimensions, metrics and questions."""

__version__ = "0.1.0"
