"""Operators for preparing language-model training data, as Spark jobs.

Each module holds one operator with its own general interface; ``queries``
holds the thin registered queries.  Nothing outside this package imports it.
"""
