"""Operators on DataFrames: order, sets, votes, matches, accounts, checks."""
