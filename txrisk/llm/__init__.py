"""Operators of a training-data pipeline over text, page and vector tables.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries.py`` holds the thin
``opN_<name>`` queries that derive the contract's columns from them.
"""
