"""Spark-native analytics over a corpus of source-code repositories."""
