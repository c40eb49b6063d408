"""Registered queries: external calls by stand-ins, and the landing stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.plans import workflow
from foliospark.plans.registry import query, table
from foliospark.session import fresh_path, materialize
from foliospark.streaming import landing


@query()
def pipeline_stub(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.concat(F.lit("explainer-"), F.col("doc_id").cast("string")).alias("custom_id"), "text")
    done = workflow.synthesise(docs, workflow.echo_model, "2026-01-02", lambda df: materialize(df, "answers"))
    return done.select("custom_id", "missing", "input_tokens", "output_tokens", "error", F.length("text").alias("n_chars"))


@query("SELECT 'r' || event_id % 500 AS custom_id, arg_max(CASE WHEN event_id % 3 = 0 THEN 'errored' ELSE 'succeeded' END, event_id) AS outcome FROM events GROUP BY ALL")
def landing_stream(spark: SparkSession, d: str) -> DataFrame:
    base = fresh_path(spark, "landing")
    events = table(spark, d, "events").select(F.concat(F.lit("r"), (F.col("event_id") % 500).cast("string")).alias("custom_id"), F.when(F.col("event_id") % 3 == 0, "errored").otherwise("succeeded").alias("outcome"), F.col("event_id").cast("bigint").alias("seq"))
    events.write.parquet(f"{base}/in")
    landing.follow(spark, f"{base}/in", "custom_id string, outcome string, seq bigint", f"{base}/out", f"{base}/state")
    return landing.current(spark, f"{base}/out")
