"""Spark-native preparation of text corpora."""
