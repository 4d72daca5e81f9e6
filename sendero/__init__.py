"""Batch engine for resolving noisy organisation names, star schemas and audits on Spark."""
