"""Incremental ingestion: new files of a folder, loaded batch by batch."""
