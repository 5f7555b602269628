"""PySpark-native document ingestion, retrieval and corpus preparation."""

__version__ = "0.1.0"
