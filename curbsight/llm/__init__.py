"""Operators of a training-data pipeline over documents and web pages.

Nothing else in the library imports this subpackage. Every operator takes and returns DataFrames; the registered
queries in ``registry`` apply them to whole tables and derive the digest columns from their results.
"""
