"""Quire: document ingestion, image text recovery and analytics on Spark."""

__version__ = "0.1.0"
