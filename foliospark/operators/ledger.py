"""The request ledger: reports, lookups and state changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_PROVIDER = "claude"
#: Remote states that mean the batch has ended.
ENDED = ("completed", "failed", "cancelled", "expired")


def provider_of(c: Column) -> Column:
    return F.coalesce(c, F.lit(DEFAULT_PROVIDER))


def batch_status(requests: DataFrame, *keys: str) -> DataFrame:
    """Counts and sums per batch. ``requests`` has ``type, result`` and usage
    columns, which may be null."""
    explainer = F.col("type") == "explainer"
    total = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)))
    return requests.groupBy(*keys).agg(
        F.count_if(explainer).alias("n_total"),
        F.count_if(explainer & (F.col("result") == "succeeded")).alias("n_succeeded"),
        F.count_if(explainer & (F.col("result") == "errored")).alias("n_errored"),
        F.count_if(F.col("type") == "lane").alias("n_lanes"),
        total("input_tokens").alias("tokens_in"),
        total("output_tokens").alias("tokens_out"),
        total("batch_cost_usd").alias("effective_usd"),
        total("standard_cost_usd").alias("standard_usd"),
        total("saving_usd").alias("saving_usd"),
    )


def grand_total(status: DataFrame) -> DataFrame:
    """One row over all batches, or none if nothing was spent."""
    sums = status.agg(F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.sum("effective_usd").alias("effective_usd"), F.sum("standard_usd").alias("standard_usd"))
    return sums.withColumn("saving_usd", F.col("standard_usd") - F.col("effective_usd")).filter("effective_usd > 0")


def lanes_present(requests: DataFrame, *keys: str) -> DataFrame:
    """Whether any request of a batch is a lane."""
    return requests.groupBy(*keys).agg(F.bool_or(F.col("type") == "lane").alias("lanes"))


def cost_summary(requests: DataFrame, *keys: str) -> DataFrame:
    """Cost of the requests that have usage; batches without any give no row."""
    return requests.filter("input_tokens is not null").groupBy(*keys).agg(F.sum("batch_cost_usd").alias("effective_usd"), F.sum("standard_cost_usd").alias("standard_usd"), F.sum("saving_usd").alias("saving_usd"))


def latest_pending(batches: DataFrame, seq: str, *keys: str) -> DataFrame:
    """The newest batch still processing, per ``keys``.

    A maximum of a struct is combined on the map side, unlike a ranking window.
    """
    rest = [c for c in batches.columns if c not in keys]
    top = F.max(F.struct(F.col(seq).alias("_seq"), *rest)).alias("top")
    return batches.filter("status = 'processing'").groupBy(*keys).agg(top).select(*keys, *(F.col(f"top.{c}").alias(c) for c in rest))


def newest(rows: DataFrame, seq: str, value: str, *keys: str) -> DataFrame:
    """The newest non-null ``value`` of each key."""
    return rows.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(value, seq).alias(value))


def apply_results(requests: DataFrame, results: DataFrame, key: str = "custom_id") -> DataFrame:
    """Requests with their results; those without stay pending, unknown
    results are dropped. ``results`` has the key, ``outcome`` and ``message``."""
    joined = requests.join(results, key, "left")
    return joined.withColumn("result", F.coalesce(F.when(F.col("outcome") == "errored", "errored").when(F.col("outcome").isNotNull(), "succeeded"), F.lit("pending"))).withColumn("error", F.when(F.col("outcome") == "errored", F.coalesce("message", F.lit("Unknown error"))))


def upsert(ledger: DataFrame, changes: DataFrame, *keys: str) -> DataFrame:
    """``changes`` over ``ledger``: rows with equal keys are replaced."""
    return ledger.join(changes.select(*keys).distinct(), list(keys), "left_anti").unionByName(changes, allowMissingColumns=True)


def remote_status(state: Column, total: Column, done: Column, failed: Column) -> Column:
    """Struct (status, processing) of a remote batch."""
    return F.struct(F.when(state.isin(*ENDED), "ended").otherwise(state).alias("status"), F.greatest(total - done - failed, F.lit(0)).alias("processing"))


def listing(batches: DataFrame, seq: str) -> DataFrame:
    return batches.orderBy(F.col(seq).desc())


def ended(batches: DataFrame, remote: DataFrame, key: str = "batch_id") -> DataFrame:
    """Batches after a poll: those whose remote state has ended are no longer
    processing. ``remote`` has the key and ``status``; others stay as they are."""
    joined = batches.join(remote.select(key, F.col("status").alias("_remote")), key, "left")
    done = (F.col("status") == "processing") & F.coalesce(F.col("_remote") == "ended", F.lit(False))
    return joined.withColumn("status", F.when(done, "ended").otherwise(F.col("status"))).drop("_remote")


def resumed(batches: DataFrame, requests: DataFrame, batch_id: str) -> DataFrame:
    """The requests of one batch that wait for results, if it is processing: what
    another process takes up again with nothing but the id."""
    open_ = batches.filter((F.col("batch_id") == batch_id) & (F.col("status") == "processing")).select("batch_id")
    return requests.filter((F.col("batch_id") == batch_id) & (F.col("result") == "pending")).join(open_, "batch_id", "left_semi")


def file_cache_action(inputs: DataFrame, cache: DataFrame, key: str = "filename", remote: DataFrame | None = None) -> DataFrame:
    """``reuse`` where the cached content hash is the same and the file is still
    among those of ``remote`` (file_id), else ``upload``."""
    cached = cache.select(key, F.col("sha256").alias("_cached"), "file_id")
    if remote is not None:
        cached = cached.join(remote.select("file_id").distinct(), "file_id", "left_semi")
    joined = inputs.join(cached, key, "left")
    same = F.coalesce(F.col("_cached") == F.col("sha256"), F.lit(False))
    return joined.withColumn("action", F.when(same, "reuse").otherwise("upload")).withColumn("file_id", F.when(same, F.col("file_id"))).drop("_cached")


def at_most_once(rows: DataFrame, seq: str, *keys: str) -> DataFrame:
    """The last row of each key (same name: the later write wins)."""
    rest = [c for c in rows.columns if c not in keys]
    top = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(seq, *(c for c in rest if c != seq))).alias("_top"))
    return top.select(*(F.col(c) if c in keys else F.col(f"_top.{c}") for c in rows.columns))
