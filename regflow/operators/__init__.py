"""Relational building blocks: DataFrames in, DataFrame out."""
