"""Plug points for external programs: PDF tools, image tools, exporters.

A tool is a function from one row (a dict) to one row (a dict). It runs in
``mapInPandas``; a row that raises becomes a row with its error, so one broken
file never fails a job. Which programs stand behind a tool is the caller's
choice; none is needed here.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.batches import frugal, small_batches
from foliospark.functions.text import html_name
from foliospark.sources.sinks import export_summary

Tool = Callable[[dict], dict]


def apply_tool(rows: DataFrame, tool: Tool, keys: list[str], schema: str) -> DataFrame:
    """``keys``, the columns of ``schema`` and ``error`` for every row."""
    small_batches(rows.sparkSession)
    names = [x.split()[0] for x in schema.split(",")]
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in keys)
    order = [f.name for f in rows.schema if f.name in keys]

    def one(row: dict) -> dict:
        try:
            made, error = tool(row), None
        except Exception as problem:  # noqa: BLE001  a row's failure is a result
            made, error = {}, str(problem)
        return {k: row[k] for k in order} | {n: made.get(n) for n in names} | {"error": error}

    def run(frames):
        for frame in frames:
            yield pd.DataFrame([one(r) for r in frame.to_dict("records")], columns=[*order, *names, "error"])

    return rows.mapInPandas(frugal(run), f"{kept}, {schema}, error string")


def export_pages(paths: DataFrame, exporter: Tool) -> tuple[DataFrame, DataFrame]:
    """(exports, summary): every distinct path once, with its page name."""
    named = paths.select("path").distinct().withColumn("page", html_name(F.col("path")))
    done = apply_tool(named, exporter, ["path", "page"], "exported string")
    exports = done.withColumn("ok", F.col("error").isNull()).orderBy("path")
    return exports, export_summary(exports)
