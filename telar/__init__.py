"""Telar: Spark-native analytics over records, documents and vectors."""
