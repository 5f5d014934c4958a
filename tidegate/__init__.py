"""Data-quality, ingestion and reconciliation operators as Spark plans."""

__version__ = "0.1.0"
