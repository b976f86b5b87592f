"""Column helpers: plain Spark expressions, no Python UDFs."""
