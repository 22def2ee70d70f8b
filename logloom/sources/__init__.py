"""Readers and writers: log lines, labels, structured tables, the ingest ledger."""
