"""Spark-native analytics engine for messy multi-source listings."""
