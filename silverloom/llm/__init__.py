"""Operators for preparing training data, their registered queries and SQL."""
