"""Composed flows, spark.ml models and metrics, plus the registered query catalog."""
