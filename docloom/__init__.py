"""Spark-native document analytics, passage building and retrieval."""
