"""A landing folder as a stream that drives the request ledger.

Results arrive as Parquet files. Every micro-batch changes the state of its
requests; the sink is keyed by request and idempotent, so a batch that runs
again after a crash changes nothing. Of several results of a request the last
one counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def follow(spark: SparkSession, landing: str, schema: str, out: str, checkpoint: str) -> None:
    """Take in everything that has landed and stop. ``schema`` must hold
    ``custom_id, outcome``, and ``seq`` for the order of arrival within a batch
    (else the order of reading holds); each batch goes to ``out/batch=<id>``."""

    def store(batch: DataFrame, batch_id: int) -> None:
        ordered = batch if "seq" in batch.columns else batch.withColumn("seq", F.monotonically_increasing_id())
        last = ordered.groupBy("custom_id").agg(F.max_by("outcome", "seq").alias("outcome"))
        last.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    stream = spark.readStream.schema(schema).parquet(landing)
    query = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def current(spark: SparkSession, out: str) -> DataFrame:
    """The latest state of every request."""
    rows = spark.read.parquet(out)
    return rows.groupBy("custom_id").agg(F.max_by("outcome", "batch").alias("outcome"))


def is_ended(status: DataFrame) -> bool:
    """Whether a polled batch needs no further poll (one status row)."""
    row = status.select("status").first()
    return row is not None and row["status"] == "ended"
