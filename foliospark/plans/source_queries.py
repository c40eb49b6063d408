"""Registered queries: sources and sinks, over files made from the tables.

Readers and sinks need files; the queries write them to the shared folder first.
Files that need a name are made of ``nation``, a table of fixed size.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions import arguments
from foliospark.functions import text as T
from foliospark.operators import figures, requests
from foliospark.plans.registry import query, table
from foliospark.session import fresh_path
from foliospark.sources import external, readers, sinks

TODAY = "2026-01-01"


def _nations(spark: SparkSession, d: str) -> list[tuple[int, str, int]]:
    return [(r.n_nationkey, r.n_name, r.n_regionkey) for r in table(spark, d, "nation").orderBy("n_nationkey").collect()]


def _folder(spark: SparkSession, name: str, files: dict[str, bytes]) -> str:
    base = fresh_path(spark, name)
    for file, content in files.items():
        sinks.put_file(spark, f"{base}/{file}", content)
    return base


def _lines(rows: DataFrame, name: str) -> str:
    """A folder of text files with the rows' only column."""
    base = fresh_path(rows.sparkSession, name)
    rows.write.text(base)
    return base


@query("""SELECT n_name || ' ' || n_nationkey || '.PDF' AS filename, 'explainer-' || regexp_replace(n_name || ' ' || n_nationkey, '[^a-zA-Z0-9_-]', '-', 'g') AS custom_id,
  sha256(repeat(n_name, (n_nationkey * 40 + 1)::BIGINT)) AS sha256, round(length(n_name) * (n_nationkey * 40 + 1) / 1024)::BIGINT AS size_kb, base64(encode(repeat(n_name, (n_nationkey * 40 + 1)::BIGINT))) AS base64
  FROM nation WHERE n_nationkey % 3 <> 0""")
def pdf_scan(spark: SparkSession, d: str) -> DataFrame:
    files = {f"{name} {k}.PDF" if k % 3 else f"{name}.txt": (name * (k * 40 + 1)).encode() for k, name, _ in _nations(spark, d)}
    return readers.pdf_files(spark, _folder(spark, "pdfs", files))


@query("SELECT n_name || '.pdf' AS filename, CASE WHEN n_nationkey % 4 = 0 THEN 'look at ' || n_name END AS hint, CASE WHEN n_nationkey % 4 = 0 THEN 'Figure ' || (n_nationkey + 1) END AS source_figure FROM nation")
def focus_sidecars(spark: SparkSession, d: str) -> DataFrame:
    nations = _nations(spark, d)
    files = {f"{name}.pdf": b"x" for _, name, _ in nations}
    files |= {f"{name}.focus.md": f"look at {name}\nimage: fig {k + 1}".encode() if k % 4 == 0 else b"  \n " for k, name, _ in nations if k % 4 < 2}
    base = _folder(spark, "notes", files)
    return readers.with_focus(readers.pdf_files(spark, base), readers.focus_notes(spark, base)).select("filename", "focus.hint", "focus.source_figure")


_IS_PDF = "(split_part(lower(url), '?', 1) LIKE '%.pdf' OR contains(split_part(lower(url), '?', 1), 'arxiv.org/pdf/'))"


def _fetch(urls):
    import pandas as pd

    n = urls.str.len()
    return pd.DataFrame({"status": (n % 5 == 0).map({True: 404, False: 200}), "content_type": (n % 7 == 0).map({True: "application/pdf", False: "text/html"}), "html": "<p>" + urls + " &amp; x</p>"})


@query(f"SELECT url, CASE WHEN length(url) % 5 <> 0 AND length(url) % 7 <> 0 THEN url || ' & x' END AS body FROM pages WHERE NOT {_IS_PDF}", plug_point=True)
def page_fetch(spark: SparkSession, d: str) -> DataFrame:
    urls = table(spark, d, "pages").select("url", T.is_pdf_url(F.col("url")).alias("is_pdf"))
    return readers.fetched_pages(urls, _fetch)


@query("""SELECT 0 AS part, 'explainer-' || regexp_replace(n_name, '[^a-zA-Z0-9_-]', '-', 'g') AS custom_id, n_name || '.pdf' AS input, 'local_pdf' AS kind, NULL AS body, NULL AS hint FROM nation
  UNION ALL SELECT 1, 'explainer-url-' || substr(regexp_replace(regexp_replace(p.url, '^https?://', ''), '[^a-zA-Z0-9_-]', '-', 'g'), 1, 80), p.url, 'url', b.body, CASE WHEN page_id % 3 = 1 THEN 'see ' || page_id END
  FROM pages p JOIN (SELECT url, 'page ' || min(page_id) AS body FROM pages GROUP BY url) b USING (url) WHERE page_id % 3 <> 0""")
def input_union(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    lines = pages.select(F.expr("CASE page_id % 3 WHEN 0 THEN concat('# ', url) WHEN 1 THEN concat(' ', url, '  # Focus: see ', page_id) ELSE url END").alias("value"))
    urls = readers.url_list(spark, _lines(lines, "urls"))
    pdfs = table(spark, d, "nation").select(T.pdf_custom_id(F.concat("n_name", F.lit(".pdf"))).alias("custom_id"), F.concat("n_name", F.lit(".pdf")).alias("filename"), F.lit(None).cast(urls.schema["focus"].dataType).alias("focus"))
    bodies = pages.groupBy("url").agg(F.concat(F.lit("page "), F.min("page_id").cast("string")).alias("body"))
    return requests.input_items(pdfs, urls, bodies).select("part", "custom_id", "input", "kind", "body", "focus.hint")


@query("""SELECT 'explainer-' || n_nationkey AS custom_id, 'b' || n_regionkey AS batch_id, CASE WHEN n_nationkey % 2 = 0 THEN 'lane' ELSE 'explainer' END AS type, n_name AS input, CASE WHEN n_nationkey % 5 > 0 THEN 'succeeded' END AS result,
  CASE WHEN n_nationkey % 3 > 0 THEN n_nationkey * 10 END::BIGINT AS input_tokens FROM nation""")
def ledger_load(spark: SparkSession, d: str) -> DataFrame:
    rows = [{"custom_id": f"explainer-{k}", "batch_id": f"b{r}", "type": "explainer" if k % 2 else "lane", "input": name, "result": "succeeded" if k % 5 else None, "usage": {"input_tokens": k * 10} if k % 3 else None} for k, name, r in _nations(spark, d)]
    base = _folder(spark, "ledger", {"state.json": json.dumps([*rows, {"batch_id": "none"}]).encode(), "broken.json": b"{"})
    every = [readers.ledger(spark, f"{base}/{x}.json") for x in ("state", "broken", "absent")]
    return every[0].unionAll(every[1]).unionAll(every[2]).select("custom_id", "batch_id", "type", "input", "result", "usage.input_tokens")


@query("""SELECT 'e' || event_id AS custom_id, CASE WHEN event_id % 4 > 1 THEN 'succeeded' ELSE 'errored' END AS outcome, CASE WHEN event_id % 4 > 1 THEN 't' || event_id END AS text, CASE WHEN event_id % 4 > 1 THEN event_id END AS input_tokens,
  CASE WHEN event_id % 4 > 1 THEN 7 END::BIGINT AS output_tokens, CASE event_id % 4 WHEN 0 THEN '{"type":"invalid","n":' || event_id || '}' WHEN 1 THEN 'canceled' END AS message FROM events""")
def message_results_read(spark: SparkSession, d: str) -> DataFrame:
    content = """concat('[{"type":"thinking","text":"no"},{"type":"text","text":"t', event_id, '"},{"type":"text","text":"u"}]')"""
    line = f"""CASE event_id % 4 WHEN 0 THEN concat('{{"custom_id":"e', event_id, '","result":{{"type":"errored","error":{{"type":"invalid","n":', event_id, '}}}}}}')
      WHEN 1 THEN concat('{{"custom_id":"e', event_id, '","result":{{"type":"canceled"}}}}')
      ELSE concat('{{"custom_id":"e', event_id, '","result":{{"type":"succeeded","message":{{"content":', {content}, ',"usage":{{"input_tokens":', event_id, ',"output_tokens":7}}}}}}}}') END"""
    return readers.message_results(spark, _lines(table(spark, d, "events").select(F.expr(line).alias("value")), "messages"))


@query("""SELECT 'e' || event_id AS custom_id, CASE WHEN event_id % 5 = 0 THEN 'errored' ELSE 'succeeded' END AS outcome, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'own ' || event_id ELSE 'a' || event_id || chr(10) || 'b' END AS text,
  CASE WHEN event_id % 5 > 2 THEN event_id ELSE 0 END AS input_tokens, CASE WHEN event_id % 5 > 2 THEN 3 ELSE 0 END::BIGINT AS output_tokens, CASE WHEN event_id % 5 = 0 THEN 'Missing response body' END AS message FROM events
  UNION ALL SELECT 'x' || event_id, 'errored', NULL, 0, 0, CASE WHEN event_id % 2 = 0 THEN 'bad ' || event_id ELSE 'Request failed' END FROM events WHERE event_id % 7 = 0""")
def response_results_read(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    output = """concat('{"custom_id":"e', event_id, '","response":', CASE WHEN event_id % 5 = 0 THEN 'null' ELSE concat('{"body":{"output_text":"', CASE WHEN event_id % 5 = 1 THEN concat(' own ', event_id) ELSE ' ' END,
      '","output":[{"content":[{"text":"a', event_id, '"},{"text":"b "}]}]', CASE WHEN event_id % 5 > 2 THEN concat(',"usage":{"input_tokens":', event_id, ',"output_tokens":3}') ELSE '' END, '}}') END, '}')"""
    failed = """concat('{"custom_id":"x', event_id, '"', CASE WHEN event_id % 2 = 0 THEN concat(',"error":{"message":"bad ', event_id, '"}') ELSE '' END, '}')"""
    first = _lines(events.select(F.expr(output).alias("value")), "output")
    return readers.response_results(spark, first, _lines(events.filter("event_id % 7 = 0").select(F.expr(failed).alias("value")), "errors"))


@query("SELECT n_name AS provider, 'batchModel' AS key, 'm-' || n_nationkey AS value FROM nation UNION ALL SELECT n_name, 'maxTokens', n_nationkey::VARCHAR FROM nation")
def model_config_read(spark: SparkSession, d: str) -> DataFrame:
    config = {"_comment": "x"} | {name: {"batchModel": f"m-{k}", "maxTokens": k} for k, name, _ in _nations(spark, d)}
    base = _folder(spark, "config", {"models.json": json.dumps(config).encode(), "broken.json": b"{"})
    return readers.model_config(spark, f"{base}/models.json").unionAll(readers.model_config(spark, f"{base}/broken.json"))


@query("SELECT n_name AS key, CASE WHEN n_nationkey = 0 THEN 'shell' WHEN n_nationkey % 2 = 0 THEN 'a' || n_nationkey ELSE 'b' || n_nationkey END AS value FROM nation WHERE n_nationkey % 2 = 0 OR n_nationkey % 3 = 0")
def dotenv_fill(spark: SparkSession, d: str) -> DataFrame:
    nations = _nations(spark, d)
    first = "\n".join(["# c", *(f"{name} = 'a{k}'" for k, name, _ in nations if k % 2 == 0)])
    second = "\n".join(["bad", *(f'{name}="b{k}"' for k, name, _ in nations if k % 3 == 0)])
    filled = readers.fill_env({nations[0][1]: "shell"}, first, second)
    return spark.createDataFrame(list(filled.items()), "key string, value string")


@query("SELECT doc_id, unnest(l) AS text, generate_subscripts(l, 1) AS page FROM (SELECT doc_id, string_split(replace(text, '. ', chr(12)), chr(12)) AS l FROM documents)")
def page_split(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "documents").select("doc_id", F.replace("text", F.lit(". "), F.lit("\f")).alias("text"))
    return readers.split_pages(texts, ["doc_id"]).select("doc_id", "text", F.col("page").cast("bigint").alias("page"))


@query("""SELECT p_partkey, 0 AS seq, p_size + 0.5::DOUBLE AS x_min, 10::DOUBLE AS y_min, (p_size + 3)::DOUBLE AS x_max, 20::DOUBLE AS y_max, p_name AS text FROM part
  UNION ALL SELECT p_partkey, 2, 0, p_size, 0, NULL, 'b' FROM part""")
def boxed_words(spark: SparkSession, d: str) -> DataFrame:
    markup = """concat('<word xMin="', p_size, '.5" yMin="10" xMax="', p_size + 3, '" yMax="20">', p_name, '</word><word xMin="1">skip</word> <word yMin="', p_size, '">b </word>')"""
    return readers.boxed_words(table(spark, d, "part").select("p_partkey", F.expr(markup).alias("markup")), ["p_partkey"])


@query("SELECT p_partkey, 612::DOUBLE AS width, p_size::DOUBLE AS height, 0 AS seq, 1.5::DOUBLE AS x_min, 2::DOUBLE AS y_min, 3::DOUBLE AS x_max, p_size + 0.25::DOUBLE AS y_max, p_name AS text FROM part WHERE p_partkey % 3 > 0")
def layout_words(spark: SparkSession, d: str) -> DataFrame:
    markup = """concat(CASE WHEN p_partkey % 3 > 0 THEN concat('<page id="1" width="612.0" height="', p_size, '">') ELSE '<page width="0" height="5">' END, '<word xMin="1.5" yMin="2" xMax="3" yMax="', p_size, '.25" k="1"> ', p_name, '</word><word xMin="1">x</word></page>')"""
    return readers.layout_words(table(spark, d, "part").select("p_partkey", F.expr(markup).alias("markup")), ["p_partkey"])


@query("SELECT p_partkey, 1 AS seq, p_size::DOUBLE AS x_min, 20::DOUBLE AS y_min, (p_size + 30)::DOUBLE AS x_max, p_name || chr(9) || 'b' AS text FROM part")
def tabular_words(spark: SparkSession, d: str) -> DataFrame:
    cells = lambda level, size, text: f"concat_ws('\t', '{level}', '1', '1', '1', '1', '1', {size}, '20', '30', '10', '96', {text})"
    lines = [cells("level", "'left'", "'text'"), cells(5, "cast(p_size as string)", "p_name, 'b'"), cells(4, "'1'", "'no'"), cells(5, "'x'", "' '")]
    return readers.tabular_words(table(spark, d, "part").select("p_partkey", F.expr(f"concat_ws('\n', {', '.join(lines)})").alias("tsv")), ["p_partkey"])


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 > 0 THEN p_size + 0.25::DOUBLE END AS width, CASE WHEN p_partkey % 4 > 0 THEN 792::DOUBLE END AS height FROM part")
def page_size_text(spark: SparkSession, d: str) -> DataFrame:
    info = F.expr("CASE WHEN p_partkey % 4 > 0 THEN concat('Pages: 3\nPage size:      ', p_size, '.25 x 792 pts (letter)') ELSE 'Page size: none' END")
    return table(spark, d, "part").select("p_partkey", readers.page_size(info).alias("x")).select("p_partkey", "x.width", "x.height")


_LISTING = "concat('page   num  type   width height color\n--------------\n   1     0 image   ', p_size * 20, '   ', p_size * 9, '  rgb\n   2     1 smask   900 900 gray')"


@query("SELECT p_partkey, 1 AS page, 'image' AS type, (p_size * 20)::INTEGER AS width, (p_size * 9)::INTEGER AS height FROM part UNION ALL SELECT p_partkey, 2, 'smask', 900, 900 FROM part")
def image_listing(spark: SparkSession, d: str) -> DataFrame:
    return readers.image_list(table(spark, d, "part").select("p_partkey", F.expr(_LISTING).alias("listing")), ["p_partkey"])


@query("SELECT p_partkey, 1 AS page FROM part WHERE p_size * 20 >= 600 AND p_size * 9 >= 300")
def embedded_pages(spark: SparkSession, d: str) -> DataFrame:
    images = readers.image_list(table(spark, d, "part").select("p_partkey", F.expr(_LISTING).alias("listing")), ["p_partkey"])
    return figures.has_embedded(images, ["p_partkey", "page"])


@query("SELECT l_orderkey, arg_min('img-' || l_linenumber || '-' || l_partkey, (-l_quantity, 'img-' || l_linenumber || '-' || l_partkey)) AS path FROM lineitem GROUP BY l_orderkey")
def largest_images(spark: SparkSession, d: str) -> DataFrame:
    images = table(spark, d, "lineitem").select("l_orderkey", F.concat(F.lit("img-"), F.col("l_linenumber").cast("string"), F.lit("-"), F.col("l_partkey").cast("string")).alias("path"), F.col("l_quantity").alias("size"))
    return figures.largest_image(images, ["l_orderkey"])


@query("SELECT n_name || '.json' AS filename FROM nation WHERE n_nationkey % 3 = 0 ORDER BY filename")
def output_listing(spark: SparkSession, d: str) -> DataFrame:
    return readers.output_files(spark, _folder(spark, "results", {(f"{name}.json", f".{name}.json", f"{name}.html")[k % 3]: b"{}" for k, name, _ in _nations(spark, d)}))


@query("SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_nationkey = 7")
def record_read(spark: SparkSession, d: str) -> DataFrame:
    base = _folder(spark, "records", {f"{k}.json": json.dumps({"id": k, "name": name}).encode() for k, name, _ in _nations(spark, d)})
    asked = arguments.reextraction([f"{base}/7.json", "x.pdf", "Figure 2", "--page", "3"])
    return readers.single_record(spark, asked["json"]).select(F.try_variant_get("v", "$.id", "bigint").alias("id"), F.try_variant_get("v", "$.name", "string").alias("name"))


@query("""SELECT * FROM (VALUES (0, 'claude', false, NULL, false), (1, 'openai', true, 'b7', false), (2, 'openai', true, NULL, true), (3, 'claude', true, NULL, false), (4, 'claude', true, NULL, true)) AS t(id, provider, explicit, batch_id, sync)""")
def arguments_read(spark: SparkSession, d: str) -> DataFrame:
    cases = [([], {}, True), (["--provider", "openai", "b7"], {}, True), (["--sync"], {"PROVIDER": "openai"}, True), (["--provider", "other"], {}, False), (["--provider", "claude", "--sync"], {"PROVIDER": "openai"}, True)]
    found = [arguments.command(args, env, polls) for args, env, polls in cases]
    return spark.createDataFrame([(k, x["provider"], x["explicit"], x["batch_id"], x["sync"]) for k, x in enumerate(found)], "id int, provider string, explicit boolean, batch_id string, sync boolean")


@query("SELECT r_regionkey::VARCHAR AS batch_id, 'claude' AS provider, r_name AS first, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) AS n FROM region WHERE r_regionkey % 2 = 0")
def job_files(spark: SparkSession, d: str) -> DataFrame:
    base, nations = fresh_path(spark, "jobs"), _nations(spark, d)
    regions = {r.r_regionkey: r.r_name for r in table(spark, d, "region").collect()}
    for key, name in regions.items():
        sinks.put_job(spark, base, {"id": str(key), "model": name}, [n for _, n, r in nations if r == key], "/out")
    for key in regions:
        if key % 2:
            sinks.remove_job(spark, base, str(key))
    rows = spark.read.option("multiLine", True).schema("batchId string, provider string, model string, papers array<string>").json(base)
    return rows.select(F.col("batchId").alias("batch_id"), "provider", F.col("model").alias("first"), F.size("papers").cast("bigint").alias("n"))


_SAVED = """SELECT 's' || conv_id || '.json' AS name, arg_max('explainer-' || conv_id || '-' || turn, turn) AS custom_id FROM conversations WHERE turn % 3 = 0 GROUP BY conv_id
  UNION ALL SELECT '2026-01-01_' || conv_id || '-' || turn || '_explainer.json', 'explainer-' || conv_id || '-' || turn FROM conversations WHERE turn % 3 = 2"""


@query(f"""SELECT 'saved' AS place, name, custom_id FROM ({_SAVED}) UNION ALL SELECT 'staged', name, custom_id FROM ({_SAVED})
  UNION ALL SELECT 'dead', '2026-01-01_' || conv_id || '-' || turn || '_error.txt', 'explainer-' || conv_id || '-' || turn FROM conversations WHERE turn % 3 = 1""")
def written_results(spark: SparkSession, d: str) -> DataFrame:
    text = """CASE turn % 3 WHEN 0 THEN concat('{"metadata": {"filename_slug": "s', conv_id, '"}}') WHEN 1 THEN 'nothing' ELSE 'Here: {"id": 1} ok' END"""
    rows = table(spark, d, "conversations").select(F.expr("concat('explainer-', conv_id, '-', turn)").alias("custom_id"), F.expr(text).alias("text"), F.col("turn").alias("seq"))
    base = fresh_path(spark, "written")
    sinks.write_results(rows, base, TODAY, f"{base}/staged")
    places = [spark.read.parquet(f"{base}/{x}").select(F.lit(x).alias("place"), "name", "custom_id") for x in ("saved", "staged", "dead")]
    return places[0].unionAll(places[1]).unionAll(places[2])


@query("SELECT 'r' || event_id AS custom_id, CASE WHEN event_id % 3 = 0 THEN 'succeeded' ELSE 'pending' END AS result FROM events UNION ALL SELECT 'n' || event_id, 'errored' FROM events WHERE event_id % 10 = 0")
def ledger_overwrite(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    named = lambda rows, letter, result: rows.select(F.concat(F.lit(letter), F.col("event_id").cast("string")).alias("custom_id"), F.lit(result).alias("result"))
    changes = named(events.filter("event_id % 3 = 0"), "r", "succeeded").unionAll(named(events.filter("event_id % 10 = 0"), "n", "errored"))
    return sinks.save_ledger(named(events, "r", "pending"), changes, fresh_path(spark, "ledger"), "custom_id")


@query("SELECT count(DISTINCT source) FILTER (WHERE source NOT LIKE '%3') AS n_ok, count(DISTINCT source) FILTER (WHERE source LIKE '%3') AS n_failed, coalesce(list(DISTINCT '/out/' || source || '.json: no tool' ORDER BY '/out/' || source || '.json: no tool') FILTER (WHERE source LIKE '%3'), []) AS failures FROM documents", plug_point=True)
def page_exports(spark: SparkSession, d: str) -> DataFrame:
    def exporter(row: dict) -> dict:
        if row["path"].endswith("3.json"):
            raise ValueError("no tool")
        return {"exported": row["page"]}

    return external.export_pages(table(spark, d, "documents").select(F.concat(F.lit("/out/"), "source", F.lit(".json")).alias("path")), exporter)[1]


@query("SELECT doc_id, 'data:image/jpeg;base64,' || base64(encode(text)) AS url FROM documents")
def data_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", sinks.data_url(F.col("text").cast("binary")).alias("url"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Figure 2' ELSE 'Figure 1' END AS source_figure, CASE WHEN doc_id % 2 = 0 THEN 'own' WHEN doc_id % 3 = 0 THEN 'Figure 2 from the source paper.' END AS caption,
  CASE WHEN doc_id % 3 = 0 THEN 'alt ' || doc_id END AS alt_text, CASE WHEN doc_id % 3 = 0 THEN 'data:' || doc_id END AS src FROM documents""")
def image_patches(spark: SparkSession, d: str) -> DataFrame:
    docs, none = table(spark, d, "documents").select("doc_id"), F.lit(None).cast("string")
    records = docs.select("doc_id", F.lit("Figure 1").alias("source_figure"), F.when(F.col("doc_id") % 2 == 0, "own").alias("caption"), none.alias("alt_text"), none.alias("src"))
    images = docs.filter("doc_id % 3 = 0").select("doc_id", F.lit("Figure 2").alias("source_figure"), none.alias("caption"), F.expr("concat('alt ', doc_id)").alias("alt_text"), F.expr("concat('data:', doc_id)").alias("src"))
    return sinks.patched_image(records, images, "doc_id").select("doc_id", "source_figure", "caption", "alt_text", "src")
