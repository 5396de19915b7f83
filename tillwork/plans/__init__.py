"""What a retail user runs: DataFrames in, DataFrames out."""
