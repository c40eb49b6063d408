"""Sources. Each reader returns a DataFrame; formats are parsed by columns."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.batches import frugal, small_batches
from foliospark.functions import jsonx as J
from foliospark.functions import text as T

LEDGER = "custom_id string, batch_id string, type string, lane string, input string, output string, result string, error string, focus_hint string, usage struct<input_tokens: bigint, output_tokens: bigint, standard_cost_usd: double, batch_cost_usd: double, saving_usd: double>"
OUTPUT_LINES = "custom_id string, response struct<body: struct<output_text: string, output: array<struct<content: array<struct<text: string>>>>, usage: struct<input_tokens: bigint, output_tokens: bigint>>>, error struct<message: string>"
#: Fixed value: fewest columns of a word line in the tabular word format.
WORD_COLUMNS = 12
#: Pages that a worker fetches, and so holds, at a time.
FETCHED = 100


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """``filename, custom_id, sha256, size_kb, base64`` of the PDFs in a folder
    (not below it; the extension in any case)."""
    files = spark.read.format("binaryFile").load(folder).withColumn("filename", F.element_at(F.split("path", "/"), -1))
    found = files.filter(T.is_pdf_name(F.col("filename")))
    encoded = F.translate(F.base64("content"), "\r\n", "")
    return found.select("filename", T.pdf_custom_id(F.col("filename")).alias("custom_id"), F.sha2("content", 256).alias("sha256"), F.round(F.length("content") / 1024).cast("bigint").alias("size_kb"), encoded.alias("base64"))


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """``url, custom_id, is_pdf`` and the focus note of every URL line."""
    lines = spark.read.text(path).select(T.trim_all(F.col("value")).alias("l")).filter(~T.is_comment_or_blank(F.col("l")))
    split = lines.select(T.split_url_line(F.col("l")).alias("x")).select("x.url", "x.note")
    return split.select("url", T.url_custom_id(F.col("url")).alias("custom_id"), T.is_pdf_url(F.col("url")).alias("is_pdf"), T.focus_directives(F.col("note")).alias("focus"))


def focus_notes(spark: SparkSession, folder: str) -> DataFrame:
    """``stem, focus`` of the sidecar notes that are not blank."""
    notes = spark.read.text(f"{folder}/*.focus.md", wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.focus\.md$", 1).alias("stem"), T.blank_to_null(F.col("value")).alias("v"))
    return notes.filter("v is not null").select("stem", T.focus_directives(F.col("v")).alias("focus"))


def with_focus(pdfs: DataFrame, notes: DataFrame) -> DataFrame:
    stem = F.regexp_replace("filename", r"(?i)\.pdf$", "")
    return pdfs.withColumn("stem", stem).join(notes, "stem", "left")


def fetched_pages(urls: DataFrame, fetch: Callable[[pd.Series], pd.DataFrame]) -> DataFrame:
    """``url, body`` of pages that are no PDFs. ``fetch`` gets URLs and gives
    ``status, content_type, html`` for at most FETCHED of them; a failed page has
    a null body."""
    small_batches(urls.sparkSession)

    def run(frames):
        for frame in frames:
            for k in range(0, len(frame), FETCHED):
                some = frame["url"].iloc[k : k + FETCHED].reset_index(drop=True)
                got = fetch(some).reset_index(drop=True)
                yield pd.concat([some, got[["status", "content_type", "html"]]], axis=1)

    pages = urls.filter(~F.col("is_pdf")).select("url").mapInPandas(frugal(run), "url string, status int, content_type string, html string")
    fine = F.col("status").between(200, 299) & ~F.coalesce(F.contains("content_type", F.lit("application/pdf")), F.lit(False))
    return pages.select("url", F.when(fine, T.page_text(F.col("html"))).alias("body"))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The request ledger; a missing or broken file is an empty ledger."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(LEDGER + ", _bad string").option("multiLine", True).option("columnNameOfCorruptRecord", "_bad").json(path)
    return rows.filter("custom_id is not null").drop("_bad")


def first_text(blocks: Column) -> Column:
    """The text of the first text block."""
    return F.get(F.filter(blocks, lambda b: b["type"] == "text"), F.lit(0))["text"]


def all_text(blocks: Column) -> Column:
    """The texts of all text blocks, by lines."""
    return F.array_join(F.transform(F.filter(blocks, lambda b: b["type"] == "text"), lambda b: b["text"]), "\n")


def output_text(body: Column) -> Column:
    """The convenience text if it is not blank, else all content texts."""
    parts = F.flatten(F.transform(body["output"], lambda o: F.transform(o["content"], lambda c: c["text"])))
    return F.coalesce(T.blank_to_null(body["output_text"]), T.trim_all(F.array_join(parts, "\n")))


def message_results(spark: SparkSession, path: str) -> DataFrame:
    """Results of the message provider: lines of ``custom_id, result``."""
    schema = "custom_id string, result struct<type: string, error: string, message: struct<content: array<struct<type: string, text: string>>, usage: struct<input_tokens: bigint, output_tokens: bigint>>>"
    rows = spark.read.schema(schema).json(path)
    done = F.col("result.type") == "succeeded"
    return rows.select("custom_id", F.when(done, "succeeded").otherwise("errored").alias("outcome"), F.when(done, first_text(F.col("result.message.content"))).alias("text"), F.col("result.message.usage.input_tokens").alias("input_tokens"), F.col("result.message.usage.output_tokens").alias("output_tokens"), F.when(~done, F.coalesce("result.error", "result.type")).alias("message"))


def response_results(spark: SparkSession, output: str, errors: str | None = None) -> DataFrame:
    """Results of the response provider: output lines, then error lines."""
    rows = spark.read.schema(OUTPUT_LINES).json(output).withColumn("fallback", F.lit("Missing response body"))
    if errors:
        failed = spark.read.schema(OUTPUT_LINES).json(errors).withColumns({"response": F.lit(None).cast(rows.schema["response"].dataType), "fallback": F.lit("Request failed")})
        rows = rows.unionByName(failed)
    bad = F.col("error").isNotNull() | F.col("response.body").isNull()
    used = lambda k: F.coalesce(F.col(f"response.body.usage.{k}"), F.lit(0)).alias(k)
    return rows.filter("custom_id is not null").select("custom_id", F.when(bad, "errored").otherwise("succeeded").alias("outcome"), F.when(~bad, output_text(F.col("response.body"))).alias("text"), used("input_tokens"), used("output_tokens"), F.when(bad, F.coalesce("error.message", "fallback")).alias("message"))


def turn_usage(spark: SparkSession, path: str) -> DataFrame:
    """Token sums of the completed turns in an event stream; lines that are no
    JSON are passed over."""
    v = spark.read.text(path).select(J.parse_strict(F.col("value")).alias("v")).filter(F.try_variant_get("v", "$.type", "string") == "turn.completed")
    total = lambda k: F.coalesce(F.sum(F.try_variant_get("v", f"$.usage.{k}", "bigint")), F.lit(0))
    return v.agg(total("input_tokens").alias("input_tokens"), total("output_tokens").alias("output_tokens"))


def split_pages(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``page`` (from 1) and ``text`` of documents with form feeds."""
    return texts.select(*keys, F.posexplode(F.split(text_col, "\f")).alias("_i", "text")).withColumn("page", F.col("_i") + 1).drop("_i")


def boxed_words(texts: DataFrame, keys: list[str], markup: str = "markup") -> DataFrame:
    """Words of ``<word xMin= .. yMax= ..>`` markup, in order."""
    number = lambda name: F.regexp_extract("w", f'{name}="([\\d.]+)"', 1).try_cast("double")
    words = texts.select(*keys, F.posexplode(F.regexp_extract_all(markup, F.lit(r"(<word\s+[^>]+>[^<]+</word>)"), F.lit(1))).alias("seq", "w"))
    return words.select(*keys, "seq", F.coalesce(number("xMin"), F.lit(0.0)).alias("x_min"), number("yMin").alias("y_min"), F.coalesce(number("xMax"), F.lit(0.0)).alias("x_max"), number("yMax").alias("y_max"), T.trim_all(F.regexp_extract("w", ">([^<]*)<", 1)).alias("text")).filter("y_min is not null")


def tabular_words(texts: DataFrame, keys: list[str], tsv: str = "tsv") -> DataFrame:
    """Words of the tabular format: level-5 lines with a position and a text."""
    lines = texts.select(*keys, F.posexplode(F.split(tsv, "\n")).alias("seq", "l")).filter("seq > 0").withColumn("c", F.split("l", "\t"))
    cell = lambda k: F.get("c", F.lit(k)).try_cast("double")
    words = lines.filter((F.size("c") >= WORD_COLUMNS) & (F.get("c", F.lit(0)) == "5"))
    text = T.trim_all(F.array_join(F.slice("c", F.lit(WORD_COLUMNS), F.size("c")), "\t"))
    return words.select(*keys, "seq", cell(6).alias("x_min"), cell(7).alias("y_min"), F.coalesce(cell(6) + cell(8), F.lit(0.0)).alias("x_max"), text.alias("text")).filter("y_min is not null and text <> ''")


def layout_words(texts: DataFrame, keys: list[str], markup: str = "markup") -> DataFrame:
    """Words with the size of their page, of ``<page width= height=>`` markup
    with ``<word xMin= yMin= xMax= yMax=>`` inside; none if the size is not
    positive."""
    page = r'<page[^>]*width="([\d.]+)"[^>]*height="([\d.]+)"'
    word = r'<word[^>]*xMin="([\d.]+)"[^>]*yMin="([\d.]+)"[^>]*xMax="([\d.]+)"[^>]*yMax="([\d.]+)"[^>]*>([^<]*)</word>'
    side = lambda k: F.regexp_extract(markup, page, k).try_cast("double")
    sized = texts.select(*keys, markup, side(1).alias("width"), side(2).alias("height")).filter("width > 0 and height > 0")
    words = sized.select(*keys, "width", "height", F.posexplode(F.regexp_extract_all(markup, F.lit(word), F.lit(0))).alias("seq", "w"))
    number = lambda k: F.regexp_extract("w", word, k).try_cast("double")
    return words.select(*keys, "width", "height", "seq", number(1).alias("x_min"), number(2).alias("y_min"), number(3).alias("x_max"), number(4).alias("y_max"), T.trim_all(F.regexp_extract("w", word, 5)).alias("text"))


def page_size(info: Column) -> Column:
    """Struct (width, height) of ``Page size: w x h pts``; null if not positive."""
    pattern = r"(?i)Page size:\s*([\d.]+)\s+x\s+([\d.]+)\s+pts"
    side = lambda k: F.regexp_extract(info, pattern, k).try_cast("double")
    return F.struct(F.when(side(1) > 0, side(1)).alias("width"), F.when(side(2) > 0, side(2)).alias("height"))


def image_list(texts: DataFrame, keys: list[str], listing: str = "listing") -> DataFrame:
    """``page, type, width, height`` of an embedded image listing."""
    lines = texts.select(*keys, F.explode(F.split(listing, "\n")).alias("l")).withColumn("c", F.split(T.trim_all(F.col("l")), r"\s+")).filter(F.size("c") >= 5)
    whole = lambda k: F.get("c", F.lit(k)).try_cast("int")
    return lines.select(*keys, whole(0).alias("page"), F.get("c", F.lit(2)).alias("type"), whole(3).alias("width"), whole(4).alias("height")).filter("page is not null")


def output_files(spark: SparkSession, folder: str) -> DataFrame:
    """``filename`` of the JSON results in a folder, by name; dot files are none."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    names = [x.getPath().getName() for x in found if x.isFile()]
    return spark.createDataFrame([(x,) for x in names if x.endswith(".json") and not x.startswith(".")], "filename string").orderBy("filename")


def single_record(spark: SparkSession, path: str) -> DataFrame:
    """``v``: the VARIANT of one JSON file."""
    return spark.read.text(path, wholetext=True).select(J.parse_strict(F.col("value")).alias("v"))


def model_config(spark: SparkSession, path: str) -> DataFrame:
    """``provider, key, value`` of a configuration file; broken: no rows."""
    v = spark.read.text(path, wholetext=True).select(J.parse_strict(F.col("value")).alias("v"))
    providers = F.map_entries(F.try_variant_get("v", "$", "map<string, variant>"))
    rows = v.select(F.explode(providers).alias("p")).filter(J.is_kind(F.col("p.value"), "object"))
    return rows.select(F.col("p.key").alias("provider"), F.explode(F.map_entries(F.try_variant_get("p.value", "$", "map<string, string>"))).alias("e")).select("provider", "e.key", "e.value")


def env_file(text: str) -> dict[str, str]:
    """Key and value lines; the last of equal keys wins, one quote goes on each
    side. Read on the driver: it configures the job and is not data."""
    found = {}
    for line in (x.strip() for x in text.split("\n")):
        key, eq, value = line.partition("=")
        if eq and not line.startswith("#"):
            value = value.strip()
            value = value[1:] if value[:1] in ("'", '"') else value
            found[key.strip()] = value[:-1] if value[-1:] in ("'", '"') else value
    return found


def fill_env(env: dict[str, str], *files: str) -> dict[str, str]:
    """``env`` over the files, earlier files over later ones."""
    out: dict[str, str] = {}
    for text in reversed(files):
        out |= env_file(text)
    return out | env
