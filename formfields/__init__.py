"""Typed field extraction from corpora of recognised pages, as Spark DataFrame jobs."""
