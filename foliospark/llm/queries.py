"""Registered queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliospark.llm import decontamination, edit_fingerprint, language_id, licenses, mixing, ngram_join, pii, quality, token_counts, toxicity

_MODULES = [token_counts, licenses, language_id, pii, decontamination, mixing, toxicity, edit_fingerprint, quality, ngram_join]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in getattr(module, "ORACLES", {}).items()}
