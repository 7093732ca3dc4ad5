"""Spark-native analytics for comparing time windows of a sky-survey archive."""
