"""Loomset: a PySpark-native engine for semantic models extracted from noisy documents."""

__version__ = "0.1.0"
