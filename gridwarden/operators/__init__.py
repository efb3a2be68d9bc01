"""Table-level operators: DataFrames in, DataFrames out."""
