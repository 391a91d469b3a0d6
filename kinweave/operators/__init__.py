"""Operators over DataFrames: blocking, top-k, features, metrics, nearest neighbours, learning."""
