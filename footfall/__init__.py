"""Behaviour analytics on Spark: ingest, hourly/daily facts, weekly reports, search."""
