"""Comparison operators over DataFrames, batch and streaming."""
