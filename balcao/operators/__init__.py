"""Operators: DataFrame in, lazy DataFrame out."""
