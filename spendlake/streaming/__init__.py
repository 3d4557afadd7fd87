"""The change feed as a Structured Streaming query."""
