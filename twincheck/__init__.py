"""Spark jobs that prove two copies of a dataset agree, or list exactly where they do not."""

__version__ = "0.1.0"
