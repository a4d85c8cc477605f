"""Spark-native match analytics: history features, data quality, evaluation, serving."""

__version__ = "0.1.0"
