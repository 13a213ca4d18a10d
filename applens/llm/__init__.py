"""Operators for preparing text corpora, and their registered queries.

Nothing else in the library imports this subpackage.
"""
