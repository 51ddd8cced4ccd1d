"""Curating software-engineering task datasets with PySpark DataFrames."""

__version__ = "0.1.0"
