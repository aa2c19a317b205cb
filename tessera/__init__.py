"""Consolidates fragments of information about people with Spark DataFrames."""
