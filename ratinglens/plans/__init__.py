"""Whole runs over the tables, and the registry of queries with their SQL counterparts."""
