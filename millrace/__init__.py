"""Millrace: raw files and event streams to clean, historised, analysis-ready tables on Spark."""

__version__ = "0.1.0"
