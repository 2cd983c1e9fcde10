"""Corpus preparation and extraction analytics on Spark DataFrames."""
