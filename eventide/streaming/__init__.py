"""Structured Streaming forms of ingest, dedup, enrichment, roll-ups and joins."""
