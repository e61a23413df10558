"""Recordings, generated series, vector files and grids as DataFrames."""
