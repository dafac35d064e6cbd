"""Operators over DataFrames with configurable column names."""
