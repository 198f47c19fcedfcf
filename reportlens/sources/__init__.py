"""Readers and writers: CSV, NDJSON, relational tables and day-partitioned datasources."""
