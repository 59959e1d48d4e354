"""Relational operators: DataFrame -> DataFrame functions over Spark SQL functions and windows."""
