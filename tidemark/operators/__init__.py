"""Operators over logs and tables. Every function takes and returns DataFrames."""
