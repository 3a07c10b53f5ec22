"""Whole jobs: ingest raw files, build facts and reports."""
