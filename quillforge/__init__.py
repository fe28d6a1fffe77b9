"""Spark-native preparation of training corpora for structured extraction."""
