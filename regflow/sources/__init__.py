"""Reports, dimensions and staged files as DataFrames."""
