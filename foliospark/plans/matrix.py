"""Registered queries of the document-processing operators."""

from __future__ import annotations

from foliospark.plans import flow_queries, ledger_queries, record_queries, request_queries, source_queries, text_queries  # noqa: F401
from foliospark.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
