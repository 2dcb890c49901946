"""Spark-native analytics over multi-source news items."""
