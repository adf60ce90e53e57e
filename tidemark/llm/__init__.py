"""Operators for preparing large text corpora.

Nothing else in the library imports this subpackage. Every operator takes
DataFrames and returns a DataFrame; the names of the identifier and text columns
are parameters. Outputs hold the identifier and the operator's own columns only,
so extra input columns of any name never clash.
"""
