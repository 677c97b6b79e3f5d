"""All registered queries."""

from __future__ import annotations

from checks import curation_queries, history_queries, report_queries, storage_queries, stream_queries, text_queries
from checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "curation_queries", "history_queries", "report_queries", "storage_queries", "stream_queries", "text_queries"]
