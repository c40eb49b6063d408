"""Arguments, JSON texts that close their brackets, item isolation, order of arrival."""

import tracemalloc

import pandas as pd
import pytest
from pyspark.sql import functions as F

from foliospark.functions import arguments
from foliospark.functions import jsonx as J
from foliospark.operators import ledger
from foliospark.plans import workflow
from foliospark.sources import external, readers, sinks
from foliospark.streaming import landing


def test_text_after_a_value_is_no_value(spark):
    texts = ["1],[2", '{"a":1}],[{"b":2}', "1]}", '1,"b":2', "1}", '{"a":1} x', "1", ' {"a":[1]} ', "[1],[2]", '"],["', ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", J.parse_strict(F.col("t")).isNotNull().alias("ok"))
    assert {r.t for r in rows.collect() if r.ok} == {"1", ' {"a":[1]} ', '"],["'}


def test_a_failing_item_spoils_no_other(spark):
    def model(frame: pd.DataFrame) -> pd.DataFrame:
        if (frame["prompt"] == "bad").any():
            raise ValueError("refused")
        return workflow.echo_model(frame)

    rows = spark.createDataFrame([(k, "s", "bad" if k == 3 else "a b") for k in range(8)], "k int, system string, prompt string").coalesce(1)
    got = {r.k: (r.text, r.error) for r in workflow.call_model(rows, model, ["k"]).collect()}
    assert got == {k: (None, "refused") if k == 3 else ("a b", None) for k in range(8)}


def test_the_last_result_counts(spark, tmp_path):
    schema = "custom_id string, outcome string, seq long"
    spark.createDataFrame([("a", "succeeded", 1), ("a", "errored", 2), ("b", "errored", 1), ("b", "succeeded", 5)], schema).write.parquet(f"{tmp_path}/in")
    landing.follow(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/state")
    assert {r.custom_id: r.outcome for r in landing.current(spark, f"{tmp_path}/out").collect()} == {"a": "errored", "b": "succeeded"}


def test_last_row_of_each_key(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("a", 2, "z"), (None, 1, "n")], "k string, seq int, v string")
    assert sorted(map(tuple, ledger.at_most_once(rows, "seq", "k").collect()), key=str) == [("a", 3, None), (None, 1, "n")]


def test_arguments():
    assert arguments.reextraction(["a.json", "--page", "3", "b.pdf", "Fig 2", "--alt", "x"]) == {"json": "a.json", "pdf": "b.pdf", "label": "Fig 2", "page": 3, "caption": None, "alt": "x"}
    for bad in (["a", "b"], ["a", "b", "c", "--page", "0"], ["a", "b", "c", "--page", "x"], ["a", "b", "c", "--page"]):
        with pytest.raises(ValueError):
            arguments.reextraction(bad)
    assert arguments.command(["b1", "--sync"], {"PROVIDER": "OPENAI"}, True) == {"provider": "openai", "explicit": True, "batch_id": "b1", "sync": True}


def test_job_files_are_best_effort(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    assert sinks.put_job(spark, f"{tmp_path}/jobs", {"id": "b"}, ["a.pdf"], "/out")
    assert not sinks.put_job(spark, f"{tmp_path}/file/below", {"id": "b"}, [], "/out")
    assert sinks.remove_job(spark, f"{tmp_path}/jobs", "b") and not sinks.remove_job(spark, f"{tmp_path}/jobs", "b")


@pytest.fixture
def large_batches(spark):
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "10000")
    spark.conf.set(keys[1], str(256 << 20))
    yield
    for k, v in zip(keys, before, strict=True):
        spark.conf.set(k, v)


def test_a_model_gets_few_rows_and_bytes_at_a_time(spark, large_batches):
    def size(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"text": None, "input_tokens": len(frame), "output_tokens": frame["prompt"].str.len().sum(), "error": None}, index=frame.index)

    def most(n, chars):
        rows = spark.range(0, n, 1, 1).selectExpr("id", "'s' AS system", f"repeat('x', {chars}) AS prompt")
        found = workflow.call_model(rows, size, ["id"]).selectExpr("count(*) AS n", "max(input_tokens) AS most", "max(output_tokens) AS size").first()
        assert found.n == n
        return found

    assert most(5000, 10).most <= 1000 and most(300, 100_000).size <= 5 << 20


def test_other_plug_points_get_few_rows_at_a_time(spark, large_batches):
    def fetch(urls):
        return pd.DataFrame({"status": 200, "content_type": "text/html", "html": f"<p>{len(urls)}</p>"}, index=range(len(urls)))

    urls = spark.range(0, 5000, 1, 1).selectExpr("concat('u', id) AS url", "false AS is_pdf")
    got = readers.fetched_pages(urls, fetch).selectExpr("count(*) AS n", "count(DISTINCT url) AS urls", "max(int(trim(body))) AS most").first()
    assert (got.n, got.urls) == (5000, 5000) and got.most <= 100
    external.apply_tool(urls, lambda row: {}, ["url"], "made string")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000


def test_the_stand_in_holds_the_words_of_one_prompt():
    frame = pd.DataFrame({"system": "s", "prompt": [*("word " * 20_000 for _ in range(50)), None, " \u2003 "]})
    tracemalloc.start()
    got = workflow.echo_model(frame)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20 and list(got["input_tokens"]) == [20_000] * 50 + [0, 0]
