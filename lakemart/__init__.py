"""Marketplace lakehouse toolkit on PySpark DataFrames."""
