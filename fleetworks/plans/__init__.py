"""The analytics: each function takes DataFrames and parameters and returns a DataFrame."""
