"""Dataflow operators: entity resolution, matching, dedup, star model, quality audits, reports."""
