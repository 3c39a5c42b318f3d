"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage.

Column names that begin with two underscores are reserved for the operators.
"""
