"""Batch jobs: ingestion, training, scoring and publishing."""
