"""Operators for preparing language-model training corpora.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames; ``queries.py`` holds the thin contract queries and their SQL.
"""
