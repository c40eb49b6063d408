"""Schema drift of extracted records, and chart lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import jsonx as J
from foliospark.functions.text import html_to_plain

#: Fixed value: charts that a record keeps.
KEPT_CHARTS = 3


def paragraphs(plain: Column, rich: Column) -> Column:
    """Plain paragraphs, derived from the marked-up ones where absent."""
    return F.coalesce(plain, F.transform(rich, html_to_plain))


def takeaway(end: Column) -> Column:
    """Struct (label, body) of an end_takeaway VARIANT with drifted names."""
    body_html, rich = J.text(J.get(end, "body_html")), J.get(end, "paragraphs_html")
    joined = F.when(J.is_kind(rich, "array"), F.array_join(F.transform(J.items(rich), lambda x: html_to_plain(J.text(x))), " "))
    return F.struct(F.coalesce(J.text(J.get(end, "label")), J.text(J.get(end, "heading"))).alias("label"), F.coalesce(J.text(J.get(end, "body")), F.when(body_html.isNotNull(), html_to_plain(body_html)), joined).alias("body"))


def sections(v: Column) -> Column:
    """Array of (label, paragraphs) of a record's sections."""
    def plain(s: Column) -> Column:
        own, rich = J.get(s, "paragraphs"), J.get(s, "paragraphs_html")
        texts = lambda a: F.when(J.is_kind(a, "array"), F.transform(J.items(a), J.text))
        return F.struct(J.text(J.get(s, "label")).alias("label"), paragraphs(texts(own), texts(rich)).alias("paragraphs"))

    return F.transform(J.items(J.get(v, "sections")), plain)


def chart_raw(config_json: Column, config_raw: Column) -> Column:
    """The chart's raw configuration, made from the parsed one if absent."""
    return F.when(F.length(config_raw) > 0, config_raw).otherwise(F.when(config_json.isNotNull(), F.to_json(config_json)).otherwise(config_raw))


def kept_charts(charts: Column, legacy: Column) -> Column:
    """The first charts that are objects, else the single legacy chart."""
    objects = F.filter(charts, lambda c: c.isNotNull())
    return F.when(F.size(objects) > 0, F.slice(objects, 1, KEPT_CHARTS)).when(legacy.isNotNull(), F.array(legacy))


def image_block(override: dict[str, Column], existing: dict[str, Column]) -> Column:
    """The image a directive asks for; null without one."""
    fallback = F.concat(override["source_figure"], F.lit(" from the source paper."))
    block = F.struct(override["source_figure"].alias("source_figure"), F.coalesce(override["caption"], existing["caption"], fallback).alias("caption"), F.coalesce(override["alt_text"], existing["alt_text"], fallback).alias("alt_text"))
    return F.when(override["source_figure"].isNotNull(), block)


def joined_blocks(blocks: DataFrame, keys: list[str], seq: str, text: str) -> DataFrame:
    """Texts of streamed blocks in order, by lines."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("k"), F.col(text).alias("t"))))
    return blocks.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "\n").alias(text))
