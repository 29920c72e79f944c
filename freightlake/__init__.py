"""Freight-truck demand analytics on Spark DataFrames."""
