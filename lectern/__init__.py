"""Lectern: Spark-native analytics for text corpora and the reading of them."""

__version__ = "0.1.0"
