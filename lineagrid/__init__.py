"""Spark-native analytics for pathogen surveillance records."""
