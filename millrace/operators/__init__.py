"""Relational building blocks: DataFrames and parameters in, DataFrame out."""
