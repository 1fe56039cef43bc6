"""Spark-native data engine for click-through and conversion ranking."""

__version__ = "0.1.0"
