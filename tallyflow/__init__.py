"""tallyflow: a PySpark-native payments lakehouse (bronze -> silver -> gold)."""

__version__ = "0.1.0"
