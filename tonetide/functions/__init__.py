"""Column-level functions (scalar, calendar, text) built on pyspark.sql.functions."""
