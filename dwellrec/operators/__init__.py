"""Distributed building blocks. Each function takes and returns DataFrames."""
