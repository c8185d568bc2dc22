"""Fare analytics and rule-based pricing as PySpark DataFrame functions."""

__version__ = "0.1.0"
