"""Spark-native quality control of sensor observations."""

__version__ = "0.1.0"
