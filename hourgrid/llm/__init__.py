"""Operators for preparing training data: mixing, secrets, search, scoring, near and exact
duplicates, language identification and packing.

Nothing else in the library imports this package. Every operator is a function from
DataFrames to a DataFrame. Operators select the columns they are given by name before
anything else, so further columns of the input, whatever their names, do not matter.
"""
