"""Column helpers built only from Spark SQL functions."""
