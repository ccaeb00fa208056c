"""Spark-native analytics for long-read transcript data."""
