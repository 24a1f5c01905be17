"""Listing analytics on Spark: ingest, rule-based cleaning, rent model and rental yield."""

__all__ = ["constants", "session"]
