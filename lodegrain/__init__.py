"""Retrieval and corpus preparation on DataFrames."""
