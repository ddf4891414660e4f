"""Choosing a squad: frame and checks as DataFrames, an exact kernel per solve, reports as DataFrames."""
