"""Data and machine-learning operators as plain Spark DataFrame transformations."""

__version__ = "0.1.0"
