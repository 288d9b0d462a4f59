"""All queries of the library but those of the llm subpackage, and their SQL."""

from __future__ import annotations

from civicspark.plans import join_queries, report_queries, scalar_queries, text_queries  # noqa: F401
from civicspark.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
