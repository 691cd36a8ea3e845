"""Incremental arrival of filings."""
