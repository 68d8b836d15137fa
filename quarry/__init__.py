"""Quarry: corpus analytics on Spark DataFrames."""
