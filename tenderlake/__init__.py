"""Procurement lakehouse operators for PySpark: landing files to a star schema and its reports."""

__version__ = "0.1.0"
