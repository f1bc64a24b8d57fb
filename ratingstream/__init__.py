"""Clustering a stream of item ratings with Spark DataFrames and Structured Streaming."""

__version__ = "0.1.0"
