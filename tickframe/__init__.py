"""Spark-native intraday bar pipeline: poll log -> tick table."""

__version__ = "0.1.0"
