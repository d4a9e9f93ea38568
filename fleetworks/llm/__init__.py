"""Operators that prepare text, vectors and conversations for training.

Every operator is a function from DataFrames to a DataFrame; ``queries`` applies each to its whole table.
"""
