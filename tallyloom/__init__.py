"""Incremental table loading and shift analytics as plain Spark DataFrames."""
