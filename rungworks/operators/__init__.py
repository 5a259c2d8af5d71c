"""Reusable operators: DataFrame in, DataFrame out."""
