"""Operators for preparing language-model training data, on Spark DataFrames.

Nothing else in the library imports this subpackage.
"""
