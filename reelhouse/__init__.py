"""Retail warehouse analytics expressed as Spark DataFrame operators."""
