"""Incremental advertising-occurrence processing on Spark DataFrames."""
