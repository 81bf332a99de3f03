"""Operators for preparing language-model training data.

Each module holds one operator; ``queries`` registers the thin queries over
the given tables.  Nothing else in the package imports this folder.
"""
