"""Operators for preparing language-model training data.

Nothing outside this package imports it.  Each operator lives in a module of
its own with a general interface; ``queries`` holds the thin contract queries.
"""
