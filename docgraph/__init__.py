"""Spark-native processing and auditing of linked document collections."""
