"""Keyed weather-series analytics on Spark DataFrames."""
