"""The jobs: one function per reference model, DataFrames in, DataFrame out."""
