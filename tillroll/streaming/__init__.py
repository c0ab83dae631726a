"""Continuous ingestion of newly arriving source files."""
