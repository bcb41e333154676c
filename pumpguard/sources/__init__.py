"""Readers: streams, bounded topic reads, tables, JDBC, JSON parsing, fixture binding."""
