"""Daybook: a two-zone event lake kept one day at a time, on Spark DataFrames."""

__version__ = "0.1.0"
