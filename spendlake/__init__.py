"""Spend and asset analytics as PySpark DataFrame jobs."""
