"""Operators of a training-data pipeline, as DataFrame functions.

Each module holds one operator; ``queries`` holds the thin registered
queries over the given tables.  Nothing outside this subpackage imports it.
"""
