"""Spark-native analytics for document-extraction datasets."""
