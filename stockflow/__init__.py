"""Retail stock, sales and transfer analytics as Spark jobs."""
