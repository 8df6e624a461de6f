"""Relational operators of demand forecasting, each a function from DataFrames to a DataFrame."""
