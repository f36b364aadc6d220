"""Spark-native analytics over mobile-ad delivery events."""
