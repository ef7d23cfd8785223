"""Spark-native cleaning, reporting and profiling for tables of posts or documents."""
