"""Panel operators: DataFrames in, a DataFrame out."""
