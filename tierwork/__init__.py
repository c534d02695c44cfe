"""Layered-table data jobs for PySpark: every operator is a function from DataFrames to a DataFrame."""
