"""Spark-native engine for cleaning, deduplicating and enriching posting records."""
