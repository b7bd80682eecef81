"""Spark-first road-traffic analytics."""
