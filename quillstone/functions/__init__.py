"""Scalar functions as column expressions; Arrow UDFs only where Spark has no function."""
