"""Spark-native analytics for short market posts."""

__version__ = "0.1.0"
