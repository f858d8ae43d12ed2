"""Incremental ingestion of landed files."""
