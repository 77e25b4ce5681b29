"""Layered flight-data refinement on Spark DataFrames."""
