"""Keyed, idempotent, incremental ingest on Spark with exact run accounting."""

__version__ = "0.1.0"
