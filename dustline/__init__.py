"""Spark-native engine for gridded air-quality analytics."""

__version__ = "0.1.0"
