"""All registered queries by name; each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from tidegate.plans import gold_queries, ingest_queries, monitor_queries, quality_queries, reconcile_queries, sqlshapes

QUERIES = {**gold_queries.QUERIES, **quality_queries.QUERIES, **ingest_queries.QUERIES,
           **reconcile_queries.QUERIES, **monitor_queries.QUERIES,
           **sqlshapes.QUERIES}
