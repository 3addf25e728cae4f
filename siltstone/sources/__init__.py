"""Readers and writers: landed batches, tables, and queries on a source table."""
