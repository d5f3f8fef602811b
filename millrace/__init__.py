"""Warehouse loading, data-quality and run-log operators on Spark DataFrames."""

__version__ = "0.1.0"
