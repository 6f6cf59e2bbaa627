"""Retail price and promotion analytics as Spark DataFrame operators."""
