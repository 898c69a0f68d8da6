"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` registers them over the test
tables.
"""
