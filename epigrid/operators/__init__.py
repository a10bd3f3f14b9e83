"""Operators: every one takes and returns DataFrames."""
