"""All queries of the catalogue, registered by the modules imported here."""

from __future__ import annotations

from sendero.plans import model_queries, relational_queries, resolve_queries, text_queries
from sendero.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "model_queries", "relational_queries", "resolve_queries", "text_queries"]
