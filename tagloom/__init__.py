"""Labelled time-series engine on Spark DataFrames."""
