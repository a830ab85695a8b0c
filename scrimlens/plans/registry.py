"""All registered queries and their oracle SQL."""

from __future__ import annotations

from scrimlens.plans import compare_queries, document_queries, landing_queries, report_queries, segment_queries, source_queries, state_queries, stream_queries

_MODULES = (compare_queries, segment_queries, state_queries, document_queries, landing_queries, report_queries, source_queries, stream_queries)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
