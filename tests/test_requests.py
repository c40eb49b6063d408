from pyspark.sql import functions as F

from foliospark.operators import requests as R


def test_contents(spark):
    rows = spark.createDataFrame([("p", "u", None), (None, "u", None), (None, None, "d")], "page string, url string, data string")
    got = rows.select(R.message_content(F.col("page"), F.col("url"), F.col("data"), F.lit("do")).alias("c")).collect()
    assert [len(r.c) for r in got] == [1, 2, 2] and got[0].c[0].text == "Page content from u:\n\np\n\ndo"
    assert [tuple(r.c[0].source) for r in got[1:]] == [("url", "u"), ("base64", "d")] and got[1].c[1].text == "do"
    rows = spark.createDataFrame([("f", "url", "u", None), (None, "url", "u", None), (None, "local_pdf", None, "/x.pdf")], "file string, kind string, url string, path string")
    got = rows.select(R.response_content(F.col("file"), F.col("kind"), F.col("url"), F.col("path"), F.lit("do")).alias("c")).withColumn("flat", R.flattened(F.col("c"))).collect()
    assert got[0].c[0].file_id == "f" and got[0].flat == "Attached file ID: f\n\ndo"
    assert got[1].flat == "Paper reference URL: u\n\ndo" and got[2].flat.startswith("Local PDF path: /x.pdf\n")
    rows = spark.createDataFrame([("p", "u", None), (None, "u", None), (None, None, "/x.pdf")], "page string, url string, path string")
    local = [r.x for r in rows.select(R.local_prompt(F.col("page"), F.col("url"), F.col("path"), F.lit("do")).alias("x")).collect()]
    assert local == ["Source URL: u\n\nExtracted page text:\np\n\ndo", "The paper is at: u\n\ndo", "Read the PDF at this path: /x.pdf\n\ndo"]


def test_ledger_rows_as_inputs_and_their_pdfs(spark):
    ledger = spark.createDataFrame([("explainer-a", "HTTPS://x.org"), ("explainer-b", "b.pdf")], "custom_id string, input string")
    got = {r.custom_id: r for r in R.as_inputs(ledger, "/in/").collect()}
    assert got["explainer-a"].is_url and got["explainer-b"].source.file_path == "/in/b.pdf" and not got["explainer-b"].is_url
    pdfs = spark.createDataFrame([("explainer-b", "z.pdf"), ("explainer-b", "b.pdf"), ("explainer-url-c", "c.pdf")], "custom_id string, filename string")
    results = spark.createDataFrame([("explainer-b",), ("explainer-url-c",), ("explainer-n",)], "custom_id string")
    assert {r.custom_id: r.pdf for r in R.source_pdfs(results, pdfs).collect()} == {"explainer-b": "b.pdf", "explainer-url-c": None, "explainer-n": None}


def test_status_report(spark):
    rows = spark.createDataFrame([("b1", 2, 1, 1, 8, 1234567, 10, 1.5, 3.0, 1.5), ("b2", 1, 0, 0, 0, 0, 0, 0.0, 0.0, 0.0)], "batch_id string, n_total long, n_succeeded long, n_errored long, n_lanes long, tokens_in long, tokens_out long, effective_usd double, standard_usd double, saving_usd double")
    got = R.status_report(rows).collect()
    assert [r.batch_id for r in got] == ["b2", "b1"] and got[0].cost is None
    assert got[1].tokens == "Tokens: 1,234,567 input + 10 output" and got[1].cost.endswith("saved $1.5000")
