"""DataFrame operators. Inputs are DataFrames, column names are parameters."""
