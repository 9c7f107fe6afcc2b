"""Operators that prepare text and vectors for model training, each a Spark job of its own.

Nothing else in the library imports this package.
"""
