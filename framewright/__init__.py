"""Spark-native analytics over recorded-episode datasets."""
