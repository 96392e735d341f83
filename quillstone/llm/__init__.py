"""Operators of a training-data pipeline over tables of documents and vectors.

Nothing outside this subpackage imports it.
"""
