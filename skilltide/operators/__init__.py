"""Operators over DataFrames, one module per layer."""
