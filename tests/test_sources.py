"""Readers and sinks over small files."""

import base64
import hashlib
import json

from pyspark.sql import functions as F

from foliospark.sources import readers, sinks
from foliospark.streaming import landing


def test_folder_scan_with_notes(spark, tmp_path):
    (tmp_path / "A b.PDF").write_bytes(b"x" * 1500)
    (tmp_path / "n.txt").write_text("no")
    (tmp_path / "A b.focus.md").write_text("Look here\nimage: fig. 2\nimage_page_hint: 3\n")
    (tmp_path / "c.focus.md").write_text(" \n")
    r = readers.with_focus(readers.pdf_files(spark, str(tmp_path)), readers.focus_notes(spark, str(tmp_path))).collect()
    assert len(r) == 1 and r[0].custom_id == "explainer-A-b" and r[0].size_kb == 1
    assert r[0].sha256 == hashlib.sha256(b"x" * 1500).hexdigest() and base64.b64decode(r[0].base64) == b"x" * 1500
    assert "\n" not in r[0].base64


def test_notes_are_parsed(spark, tmp_path):
    (tmp_path / "A.focus.md").write_text("Look here\nimage: fig. 2\nimage_page_hint: 3\n")
    assert tuple(readers.focus_notes(spark, str(tmp_path)).first().focus) == ("Look here", "Figure 2", None, None, 3)


def test_url_list(spark, tmp_path):
    (tmp_path / "urls.txt").write_text("# c\n\n https://a.org/x.pdf # focus: the method\nhttp://b.org/y\n")
    got = {r.url: r for r in readers.url_list(spark, f"{tmp_path}/urls.txt").collect()}
    assert got["https://a.org/x.pdf"].is_pdf and got["https://a.org/x.pdf"].focus.hint == "the method"
    assert got["http://b.org/y"].custom_id == "explainer-url-b-org-y"


def test_fetched_pages(spark):
    import pandas as pd

    def fetch(urls):
        return pd.DataFrame({"status": [200 if "ok" in u else 404 if "no" in u else 200 for u in urls], "content_type": ["text/html" if "p" not in u else "application/pdf" for u in urls], "html": ["<p>hi</p>"] * len(urls)})

    urls = spark.createDataFrame([("ok", False), ("no", False), ("p", False), ("skip", True)], "url string, is_pdf boolean")
    assert {r.url: r.body for r in readers.fetched_pages(urls, fetch).collect()} == {"ok": "hi", "no": None, "p": None}


def test_ledger_missing_and_broken(spark, tmp_path):
    assert readers.ledger(spark, f"{tmp_path}/none.json").count() == 0
    (tmp_path / "bad.json").write_text('[{"custom_id": ')
    assert readers.ledger(spark, f"{tmp_path}/bad.json").count() == 0
    (tmp_path / "good.json").write_text(json.dumps([{"custom_id": "a", "usage": {"input_tokens": 3}}]))
    assert readers.ledger(spark, f"{tmp_path}/good.json").first().usage.input_tokens == 3


def test_results_of_both_providers(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text("\n".join(json.dumps(x) for x in [{"custom_id": "a", "result": {"type": "succeeded", "message": {"content": [{"type": "x"}, {"type": "text", "text": "T1"}, {"type": "text", "text": "T2"}], "usage": {"input_tokens": 1, "output_tokens": 2}}}}, {"custom_id": "b", "result": {"type": "expired"}}]))
    got = {r.custom_id: r for r in readers.message_results(spark, f"{tmp_path}/m.jsonl").collect()}
    assert got["a"].text == "T1" and got["b"].outcome == "errored" and got["b"].message == "expired"
    (tmp_path / "o.jsonl").write_text("\n".join(json.dumps(x) for x in [{"custom_id": "a", "response": {"body": {"output_text": " ", "output": [{"content": [{"text": "p"}, {"text": "q"}]}]}}}, {"response": {}}, {"custom_id": "c"}]))
    (tmp_path / "e.jsonl").write_text(json.dumps({"custom_id": "d", "error": {"message": "bad"}}))
    got = {r.custom_id: r for r in readers.response_results(spark, f"{tmp_path}/o.jsonl", f"{tmp_path}/e.jsonl").collect()}
    assert got["a"].text == "p\nq" and got["c"].message == "Missing response body" and got["d"].message == "bad" and len(got) == 3


def test_turn_usage(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"type":"turn.completed","usage":{"input_tokens":5,"output_tokens":1}}\nnot json\n{"type":"other"}\n{"type":"turn.completed","usage":{"input_tokens":2}}\n')
    assert tuple(readers.turn_usage(spark, f"{tmp_path}/t.jsonl").first()) == (7, 1)


def test_words_pages_and_images(spark):
    markup = '<page width="10"><word xMin="1.5" yMin="2" xMax="3" yMax="4"> a </word><word xMin="1">b</word>'
    words = readers.boxed_words(spark.createDataFrame([(1, markup)], "d long, markup string"), ["d"]).collect()
    assert [tuple(w) for w in words] == [(1, 0, 1.5, 2.0, 3.0, 4.0, "a")]
    tsv = "head\n" + "\t".join(["5"] + ["0"] * 5 + ["10", "20", "30", "1", "1", "Figure"]) + "\n" + "\t".join(["4"] * 12)
    words = readers.tabular_words(spark.createDataFrame([(1, tsv)], "d long, tsv string"), ["d"]).collect()
    assert [tuple(w) for w in words] == [(1, 1, 10.0, 20.0, 40.0, "Figure")]
    info = spark.createDataFrame([("Page size:      612 x 792 pts (letter)",), ("none",)], "i string")
    assert [tuple(r.x) for r in info.select(readers.page_size(F.col("i")).alias("x")).collect()] == [(612.0, 792.0), (None, None)]
    pages = readers.split_pages(spark.createDataFrame([(1, "a\fb")], "d long, text string"), ["d"]).collect()
    assert [(r.page, r.text) for r in pages] == [(1, "a"), (2, "b")]
    images = readers.image_list(spark.createDataFrame([(1, "page num type width height\n 3 0 image 700 400 rgb\n")], "d long, listing string"), ["d"]).collect()
    assert [tuple(r) for r in images] == [(1, 3, "image", 700, 400)]


def test_config_and_env(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"_comment": "x", "p": {"batchModel": "m", "maxTokens": 5}}')
    got = {(r.provider, r.key): r.value for r in readers.model_config(spark, f"{tmp_path}/m.json").collect()}
    assert got == {("p", "batchModel"): "m", ("p", "maxTokens"): "5"}
    (tmp_path / "bad.json").write_text("{")
    assert readers.model_config(spark, f"{tmp_path}/bad.json").count() == 0
    assert readers.env_file("# c\nA='x'\nbad\nB = y=z \nA=\"w\"") == {"A": "w", "B": "y=z"}
    assert readers.fill_env({"A": "1"}, "A=2\nB=3", "B=4\nC=5") == {"A": "1", "B": "3", "C": "5"}


def test_sinks(spark, tmp_path):
    rows = [("explainer-url-a", '{"metadata": {"filename_slug": "s/../x"}, "v": null}', 1), ("explainer-b", '{"metadata": {"filename_slug": "s/../x.json"}}', 2), ("explainer-c", "nothing", 3), ("explainer-d", "{}", 4)]
    saved, dead = sinks.split_results(spark.createDataFrame(rows, "custom_id string, text string, seq int"), "2026-01-01")
    assert {r.custom_id: r.name for r in saved.collect()} == {"explainer-b": "s-..-x.json", "explainer-d": "2026-01-01_d_explainer.json"}
    assert [tuple(r) for r in dead.collect()] == [("explainer-c", "2026-01-01_c_error.txt", "nothing")]
    lines = sinks.request_lines(spark.createDataFrame([("a", "m", 5, "s", "f1", "p"), ("b", "m", 5, "s", None, "p")], "custom_id string, model string, max_tokens int, system string, file_id string, prompt string")).collect()
    got = [json.loads(r.value) for r in lines]
    assert got[0]["body"]["input"][0]["content"] == [{"type": "input_file", "file_id": "f1"}, {"type": "input_text", "text": "p"}]
    assert got[1]["body"]["input"][0]["content"] == [{"type": "input_text", "text": "p"}] and got[1]["method"] == "POST"
    assert spark.range(1).select(sinks.data_url(F.lit(b"x" * 200)).alias("u")).first().u == "data:image/jpeg;base64," + base64.b64encode(b"x" * 200).decode()
    assert tuple(sinks.export_summary(spark.createDataFrame([("a", True, None), ("b", False, "e")], "path string, ok boolean, error string")).first()) == (1, 1, ["b: e"])


def test_written_results_and_staging(spark, tmp_path):
    rows = spark.createDataFrame([("explainer-a", "{}", 1), ("explainer-b", "bad", 2)], "custom_id string, text string, seq int")
    sinks.write_results(rows, f"{tmp_path}/out", "2026-01-01", f"{tmp_path}/staged")
    read = lambda x: [r.custom_id for r in spark.read.parquet(f"{tmp_path}/{x}").collect()]
    assert read("out/saved") == read("staged") == ["explainer-a"] and read("out/dead") == ["explainer-b"]
    ledger = sinks.save_ledger(rows, rows.limit(1).withColumn("text", F.lit("new")), f"{tmp_path}/ledger", "custom_id")
    assert sorted(r.text for r in ledger.collect()) in (["bad", "new"], ["new", "{}"])


def test_patched_image(spark):
    records = spark.createDataFrame([("a", "Figure 1", "own", None, None), ("b", "Figure 9", "c", "t", "s")], "id string, source_figure string, caption string, alt_text string, src string")
    images = spark.createDataFrame([("a", "Figure 2", None, None, "data:x")], "id string, source_figure string, caption string, alt_text string, src string")
    got = {r.id: tuple(r)[1:] for r in sinks.patched_image(records, images, "id").collect()}
    assert got == {"a": ("Figure 2", "own", "Figure 2 from the source paper.", "data:x"), "b": ("Figure 9", "c", "t", "s")}


def test_landing_is_idempotent(spark, tmp_path):
    schema = "custom_id string, outcome string"
    for k, rows in enumerate([[("a", "pending"), ("b", "succeeded")], [("a", "succeeded")]]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/in")
        for _ in range(2):
            landing.follow(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/state")
        got = {r.custom_id: r.outcome for r in landing.current(spark, f"{tmp_path}/out").collect()}
        assert got == ({"a": "pending", "b": "succeeded"} if k == 0 else {"a": "succeeded", "b": "succeeded"})
    assert landing.is_ended(spark.createDataFrame([("ended",)], "status string")) and not landing.is_ended(spark.createDataFrame([("x",)], "status string"))
