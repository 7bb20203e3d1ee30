"""Operators for preparing training text: language, dedup, mixing, tokens, scoring.

Nothing outside this package imports it.  Operators take a DataFrame and the names
of its identifying and text columns, read only those columns (others may have any
name) and accept nulls, empty tables, repeated rows and texts of any length; each
docstring says what they make of them.
"""
