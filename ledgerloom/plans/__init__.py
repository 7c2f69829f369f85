"""Reports composed from the operators. Each takes DataFrames and returns lazy DataFrames."""
