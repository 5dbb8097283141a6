"""Dimensional-warehouse building blocks on Spark DataFrames."""
