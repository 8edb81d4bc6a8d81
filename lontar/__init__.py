"""lontar: a PySpark-native engine for multi-source news data."""

__version__ = "0.1.0"
