"""Incremental warehouse loading on Spark DataFrames."""
