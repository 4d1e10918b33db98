"""lectern: a PySpark-native engine for curating document corpora."""

__version__ = "0.1.0"
