"""Spark lake for sequencing-archive metadata: landed payloads to bronze, silver, gold and reports."""

__version__ = "0.1.0"
