"""Streaming ingest and replay."""
