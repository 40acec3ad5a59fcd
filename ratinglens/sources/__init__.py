"""Readers and writers: files, JDBC tables, message topics, and the order-schema test tables."""
