"""corvane: a PySpark-native record-linkage engine."""

__version__ = "0.1.0"
