"""Tidemark: a Spark-native engine for governed service-request analytics."""
