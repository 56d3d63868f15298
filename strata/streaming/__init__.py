"""Structured Streaming ingest built from the batch operators."""
