"""Layered (bronze, silver, gold) table pipelines written as plain Spark jobs."""
