"""Operators for building training corpora from text tables.

One module per operator; ``queries.py`` binds each one to the test tables.
Nothing else in the library imports this package.
"""
