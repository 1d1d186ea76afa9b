"""Operators for building training corpora out of document tables.

Nothing else in the package imports this subpackage.
"""
