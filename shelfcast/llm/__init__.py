"""Operators for preparing training text, on Spark."""
