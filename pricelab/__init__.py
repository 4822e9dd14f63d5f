"""Tabular price modelling on Spark DataFrames."""

__version__ = "0.1.0"
