"""Sinks: results, dead letters, ledgers, requests."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions import jsonx as J
from foliospark.functions import text as T
from foliospark.operators.ledger import DEFAULT_PROVIDER, at_most_once, upsert
from foliospark.session import materialize


def parsed_results(results: DataFrame) -> DataFrame:
    """``custom_id, seq, text, v``: the VARIANT of each text, null if it is none."""
    return results.select("custom_id", "seq", "text").withColumn("v", J.extract_json(F.col("text")))


def split_results(results: DataFrame, today: str) -> tuple[DataFrame, DataFrame]:
    """(saved, dead) of rows ``custom_id, text, seq`` or of ``parsed_results``.
    Saved rows have a file name and pretty JSON, one per name (the last wins);
    dead rows did not parse and keep their raw text."""
    parsed = results if "v" in results.columns else parsed_results(results)
    good = parsed.filter("v is not null")
    slug = F.try_variant_get("v", "$.metadata.filename_slug", "string")
    named = good.select("custom_id", "seq", T.output_filename(F.coalesce(slug, F.lit("")), F.col("custom_id"), today).alias("name"), F.to_json("v", {"pretty": "true"}).alias("json"))
    stem = F.substring(F.regexp_replace("custom_id", r"^explainer-(?:url-)?", ""), 1, T.FALLBACK_SLUG_LIMIT)
    dead = parsed.filter("v is null").select("custom_id", F.concat(F.lit(f"{today}_"), stem, F.lit("_error.txt")).alias("name"), "text")
    return at_most_once(named, "seq", "name").drop("seq"), dead


def write_results(results: DataFrame, folder: str, today: str, staging: str | None = None) -> None:
    """Write ``folder/saved`` and ``folder/dead`` as tables keyed by file name,
    and what was saved to ``staging`` too, if that is given."""
    saved, dead = split_results(materialize(parsed_results(results), "parsed-results"), today)
    saved.write.mode("overwrite").parquet(f"{folder}/saved")
    dead.write.mode("overwrite").parquet(f"{folder}/dead")
    if staging:
        results.sparkSession.read.parquet(f"{folder}/saved").write.mode("overwrite").parquet(staging)


def request_lines(requests: DataFrame, url: str = "/v1/responses") -> DataFrame:
    """``value``: a JSON line per request of ``custom_id, model, max_tokens,
    system, file_id, prompt``."""
    kind = lambda name, text, file: F.struct(F.lit(name).alias("type"), text.alias("text"), file.alias("file_id"))
    none = F.lit(None).cast("string")
    attached = F.when(F.col("file_id").isNotNull(), F.array(kind("input_file", none, F.col("file_id"))))
    content = F.concat(F.coalesce(attached, F.array().cast("array<struct<type:string,text:string,file_id:string>>")), F.array(kind("input_text", F.col("prompt"), none)))
    body = F.struct(F.col("model"), F.col("max_tokens").alias("max_output_tokens"), F.col("system").alias("instructions"), F.array(F.struct(F.lit("user").alias("role"), content.alias("content"))).alias("input"))
    return requests.select(F.to_json(F.struct("custom_id", F.lit("POST").alias("method"), F.lit(url).alias("url"), body.alias("body"))).alias("value"))


def save_ledger(ledger: DataFrame, changes: DataFrame, folder: str, *keys: str) -> DataFrame:
    """Write the ledger with ``changes`` to a new folder and return it; the old
    one stays readable until the caller switches over."""
    upsert(ledger, changes, *keys).write.mode("overwrite").parquet(folder)
    return ledger.sparkSession.read.parquet(folder)


def data_url(content: Column, mime: str = "image/jpeg") -> Column:
    return F.concat(F.lit(f"data:{mime};base64,"), F.translate(F.base64(content), "\r\n", ""))


def patched_image(records: DataFrame, images: DataFrame, key: str) -> DataFrame:
    """Records with a newly made image: a caption or text given with it comes
    before the record's own, and that before a text made from the label."""
    new = images.select(key, *(F.col(c).alias(f"_{c}") for c in ("source_figure", "caption", "alt_text", "src")))
    joined = records.join(new, key, "left")
    made = F.concat("_source_figure", F.lit(" from the source paper."))
    fresh = F.col("_src").isNotNull()
    columns = {c: F.when(fresh, F.coalesce(f"_{c}", c, made)).otherwise(F.col(c)) for c in ("caption", "alt_text")}
    columns |= {c: F.when(fresh, F.col(f"_{c}")).otherwise(F.col(c)) for c in ("source_figure", "src")}
    return joined.withColumns(columns).drop("_source_figure", "_caption", "_alt_text", "_src")


def put_file(spark: SparkSession, path: str, content: bytes) -> None:
    """One small file, such as a notice for a dashboard, by Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def put_job(spark: SparkSession, folder: str, batch: dict, inputs: list[str], output: str) -> bool:
    """``<id>.json`` that tells a dashboard of a batch; whether it was written.
    The dashboard is optional, so a folder that fails changes nothing."""
    job = {"type": "explainer", "batchId": batch["id"], "provider": batch.get("provider") or DEFAULT_PROVIDER, "model": batch.get("model"), "laneModel": batch.get("lane_model"), "synthesisModel": batch.get("synthesis_model"), "papers": inputs, "outputDir": output, "submittedAt": batch.get("submitted_at")}
    try:
        put_file(spark, f"{folder}/{batch['id']}.json", json.dumps({k: v for k, v in job.items() if v is not None}, indent=2).encode())
    except Exception:  # noqa: BLE001  best effort
        return False
    return True


def remove_job(spark: SparkSession, folder: str, batch_id: str) -> bool:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{folder}/{batch_id}.json")
    try:
        return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, False)
    except Exception:  # noqa: BLE001  best effort
        return False


def export_summary(exports: DataFrame) -> DataFrame:
    """One row: exported, failed, and the failures."""
    return exports.agg(F.count_if("ok").alias("n_ok"), F.count_if(~F.col("ok")).alias("n_failed"), F.array_sort(F.collect_list(F.when(~F.col("ok"), F.concat_ws(": ", "path", "error")))).alias("failures"))
