"""Spark-native analytics for ranked-chart tables."""
