"""Comparisons and checks over DataFrames."""
