"""Incremental intake on Structured Streaming."""
