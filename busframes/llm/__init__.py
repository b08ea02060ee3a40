"""Operators of a training-data pipeline over text corpora.

Nothing else in the library imports this subpackage. Each operator module
holds its general interface; ``catalog.py`` derives the registered queries.
"""
