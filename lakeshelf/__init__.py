"""Layered lake analytics written as plain Spark jobs."""
