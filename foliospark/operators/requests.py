"""Requests to models: content of a request, and ledger rows as inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.text import source_reference

#: Fixed value: how an address starts.
ADDRESS = r"(?i)^https?://"


#: Templates; {} are the address or path, the page and the
#: instruction.
PAGE_BLOCK = "Page content from {}:\n\n{}\n\n{}"
LOCAL_PAGE = "Source URL: {}\n\nExtracted page text:\n{}\n\n{}"
LOCAL_URL = "The paper is at: {}\n\n{}"
LOCAL_FILE = "Read the PDF at this path: {}\n\n{}"
FILE_NOTE = "Attached file ID: {}"


def _filled(template: str, *values: Column) -> Column:
    pieces = template.split("{}")
    out = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:], strict=True):
        out += [value, F.lit(piece)]
    return F.concat(*out)


def message_content(page: Column, url: Column, data: Column, instruction: Column) -> Column:
    """Content blocks of the message provider: one text of page and instruction
    if there is a page, else the document by address or inline and the
    instruction."""
    none = F.lit(None).cast("string")
    block = lambda kind, text, source: F.struct(F.lit(kind).alias("type"), text.alias("text"), source.alias("source"))
    source = lambda kind, value: F.struct(F.lit(kind).alias("type"), value.alias("value"))
    empty = F.lit(None).cast("struct<type:string,value:string>")
    document = F.when(url.isNotNull(), block("document", none, source("url", url))).otherwise(block("document", none, source("base64", data)))
    paged = url.isNotNull() & (F.length(page) > 0)
    return F.when(paged, F.array(block("text", _filled(PAGE_BLOCK, url, page, instruction), empty))).otherwise(F.array(document, block("text", instruction, empty)))


def batch_payload(requests: DataFrame) -> DataFrame:
    """``value``: the JSON of each request (custom_id, model, max_tokens, system,
    content) of the message provider; its system text is marked for caching."""
    def block(b: Column) -> Column:
        by_url = b["source"]["type"] == "url"
        inline = b["source"]["type"] == "base64"
        source = F.when(b["source"].isNotNull(), F.struct(b["source"]["type"].alias("type"), F.when(by_url, b["source"]["value"]).alias("url"), F.when(inline, F.lit("application/pdf")).alias("media_type"), F.when(inline, b["source"]["value"]).alias("data")))
        return F.struct(b["type"].alias("type"), source.alias("source"), b["text"].alias("text"))

    system = F.array(F.struct(F.lit("text").alias("type"), F.col("system").alias("text"), F.struct(F.lit("ephemeral").alias("type")).alias("cache_control")))
    messages = F.array(F.struct(F.lit("user").alias("role"), F.transform("content", block).alias("content")))
    params = F.struct(F.col("model"), F.col("max_tokens"), system.alias("system"), messages.alias("messages"))
    return requests.select(F.to_json(F.struct("custom_id", params.alias("params"))).alias("value"))


def input_items(pdfs: DataFrame, urls: DataFrame, pages: DataFrame) -> DataFrame:
    """One relation of inputs, PDFs first: ``part, custom_id, input, kind, body,
    focus``. ``pdfs`` has ``custom_id, filename, focus``, ``urls`` ``custom_id,
    url, focus``; ``body`` is the text of a fetched page (``pages``: url, body)."""
    local = pdfs.select(F.lit(0).alias("part"), "custom_id", F.col("filename").alias("input"), F.lit("local_pdf").alias("kind"), "focus")
    remote = urls.join(pages.select("url", "body"), "url", "left").select(F.lit(1).alias("part"), "custom_id", F.col("url").alias("input"), F.lit("url").alias("kind"), "body", "focus")
    return local.unionByName(remote, allowMissingColumns=True)


def response_content(file_id: Column, kind: Column, url: Column, path: Column, instruction: Column) -> Column:
    """Content blocks of the response provider: the uploaded file or a reference
    to the source, then the instruction. Page texts are not used here."""
    none = F.lit(None).cast("string")
    block = lambda name, text, file: F.struct(F.lit(name).alias("type"), text.alias("text"), file.alias("file_id"))
    first = F.when(file_id.isNotNull(), block("input_file", none, file_id)).otherwise(block("input_text", source_reference(kind, url, path), none))
    return F.array(first, block("input_text", instruction, none))


def flattened(content: Column) -> Column:
    """Content blocks as one text for a command-line model; files are named."""
    parts = F.transform(content, lambda b: F.array(b["text"], F.when(b["file_id"].isNotNull(), _filled(FILE_NOTE, b["file_id"]))))
    return F.array_join(F.flatten(parts), "\n\n")


def local_prompt(page: Column, url: Column, path: Column, instruction: Column) -> Column:
    """The prompt of a local model: page text, address or file, then the
    instruction."""
    return F.when(url.isNotNull() & (F.length(page) > 0), _filled(LOCAL_PAGE, url, page, instruction)).when(url.isNotNull(), _filled(LOCAL_URL, url, instruction)).otherwise(_filled(LOCAL_FILE, path, instruction))


def as_inputs(ledger: DataFrame, folder: str) -> DataFrame:
    """Ledger rows with a source: the stored one, else by the look of the input."""
    is_url = F.col("input").rlike(ADDRESS)
    guessed = F.struct(F.when(is_url, "url").otherwise("local_pdf").alias("kind"), F.when(is_url, F.col("input")).alias("url"), F.when(~is_url, F.col("input")).alias("filename"), F.when(~is_url, F.concat(F.lit(folder.rstrip("/") + "/"), "input")).alias("file_path"))
    rows = ledger.withColumn("source", F.coalesce("source", guessed) if "source" in ledger.columns else guessed)
    return rows.withColumn("is_url", F.col("source.kind") == "url")


def source_pdfs(results: DataFrame, pdfs: DataFrame) -> DataFrame:
    """Results with the PDF they came from: the first by name whose identifier
    is the same; addresses have none."""
    own = pdfs.groupBy("custom_id").agg(F.min("filename").alias("pdf"))
    return results.join(own, "custom_id", "left").withColumn("pdf", F.when(~F.col("custom_id").startswith("explainer-url-"), F.col("pdf")))


def status_report(status: DataFrame) -> DataFrame:
    """Lines of the status report, newest batch first."""
    tokens = F.concat_ws("", F.lit("Tokens: "), F.format_number("tokens_in", 0), F.lit(" input + "), F.format_number("tokens_out", 0), F.lit(" output"))
    money = lambda c: F.format_string("$%.4f", F.col(c))
    cost = F.concat(F.lit("Cost: "), money("effective_usd"), F.lit(" (effective), "), money("standard_usd"), F.lit(" (standard), saved "), money("saving_usd"))
    counts = F.format_string("%d total, %d succeeded, %d errored, lanes %d", "n_total", "n_succeeded", "n_errored", "n_lanes")
    return status.orderBy(F.desc("batch_id")).select("batch_id", counts.alias("explainers"), F.when(F.col("tokens_in") > 0, tokens).alias("tokens"), F.when(F.col("tokens_in") > 0, cost).alias("cost"))
