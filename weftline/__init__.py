"""Declarative data pipelines expressed as plain Spark DataFrame plans."""

__version__ = "0.1.0"
