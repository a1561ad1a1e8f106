"""Operators for building training corpora (ten operators, one module each) and their queries.

Nothing else in the library imports this subpackage.
"""
