"""Data-quality layers for hospital feeds on Spark DataFrames."""
