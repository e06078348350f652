"""Relational and ML operators: DataFrame in, DataFrame out."""
