"""Commodity price and news analytics as plain Spark jobs."""
