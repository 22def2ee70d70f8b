"""Incremental ingest of new log files and running counts."""
