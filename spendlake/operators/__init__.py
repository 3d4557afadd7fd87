"""Reusable DataFrame operators: joins, keyed writes, text search, aggregation."""
