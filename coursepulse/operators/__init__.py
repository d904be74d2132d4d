"""Operators: DataFrame in, DataFrame out, nothing executed before the caller acts."""
