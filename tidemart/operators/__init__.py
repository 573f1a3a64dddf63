"""The operators: each takes DataFrames and returns a DataFrame, with no I/O inside."""
