"""OLAP, ranking, checking and profiling operators. Each takes and returns lazy DataFrames."""
