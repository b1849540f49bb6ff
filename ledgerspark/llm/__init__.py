"""Operators for preparing training text, each over DataFrames of documents.

Nothing else in the library imports this package. Operators take column names, keep
nulls, empty texts and repeated rows, and return the columns named in their
docstrings; further columns of the input never reach them, so their names cannot
clash.
"""
