"""Spark-native cleaning, profiling and dimensional-warehouse toolkit."""
