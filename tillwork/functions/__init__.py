"""Column expressions used by more than one plan. None of them is a Python UDF."""
