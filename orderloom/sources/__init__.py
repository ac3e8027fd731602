"""Readers for extracts, mappings, reports and file listings."""
