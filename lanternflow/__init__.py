"""Spark-first lead verification, enrichment and reporting engine."""
