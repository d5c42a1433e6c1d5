"""Curation of application listings and data processing on Spark DataFrames."""
