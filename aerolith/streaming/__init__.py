"""Incremental forms of ingestion, rollup and correction."""
