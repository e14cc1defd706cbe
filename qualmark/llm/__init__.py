"""Operators for building training data from large text corpora.

Nothing else in the library imports this subpackage; it may import the
library's general helpers. Each module holds one operator, ``queries.py`` the
registered queries and their SQL.
"""
