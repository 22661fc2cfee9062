"""Operators for preparing text training data. Nothing else in the library imports this package."""
