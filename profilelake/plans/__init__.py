"""Whole runs: ingest, document building, and the query engine over stored tables."""
