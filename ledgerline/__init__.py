"""Spark-native invoice ETL and incremental-load library."""
