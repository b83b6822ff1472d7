"""Spark-native analytics over successive publications of transit schedule feeds."""

__version__ = "0.1.0"
