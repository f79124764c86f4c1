"""Column functions. All are built-in Spark expressions; there are no UDFs."""
