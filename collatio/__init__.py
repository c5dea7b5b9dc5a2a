"""Spark-native document fidelity analytics."""

__version__ = "0.1.0"
