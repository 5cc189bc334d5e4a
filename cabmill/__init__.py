"""Batch trip analytics as Spark jobs: ingest, star schema, marts, contracts."""
