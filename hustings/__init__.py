"""Spark-native analytics over civic records."""
