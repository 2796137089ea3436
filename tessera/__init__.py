"""Spark-native analytics operators: every operator is a lazy DataFrame -> DataFrame function."""
