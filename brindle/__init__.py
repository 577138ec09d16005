"""Brindle: bounded table reads, reports and in-place text normalisation on PySpark."""
