"""Registered queries: validation, normalisation, repair of records."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions import jsonx as J
from foliospark.functions.text import trim_all
from foliospark.operators import normalize, validate
from foliospark.plans.registry import query, table
from foliospark.session import materialize

DATE = "2026-01-02"
_ANCHOR = '<a href="https://x.org/a" target="_blank" rel="noopener noreferrer">x</a>'
GOOD = {
    "version": 1,
    "metadata": {"title": "T", "filename_slug": f"{DATE}_doe_a-b_explainer", "date_created": DATE},
    "hero": {"headline": "h", "headline_html": "h", "subtitle": "s", "publication_date": "Published May 2024"},
    "top_block": {"kind": "pills", "pills": [{"number": "1", "description": "d", "accent_color": "red"}, {"number": "2", "description": "d", "accent_color": "red"}]},
    "sections": [{"label": "L", "paragraphs": ["p"]}],
    "end_takeaway": {"label": "l", "body": "b"},
    "references": [_ANCHOR],
}


def _case(path: str, value) -> dict:
    """GOOD with one value changed ('-' takes it away)."""
    out = json.loads(json.dumps(GOOD))
    at = out
    *steps, last = path.split(".")
    for step in steps:
        at = at[int(step)] if step.isdigit() else at[step]
    if value == "-":
        del at[last]
    else:
        at[int(last) if last.isdigit() else last] = value
    return out


#: Faults of the upper part and the issues they must give.
TOP_CASES = (
    (GOOD, ()),
    ([1], ("Output is not a JSON object.",)),
    (_case("version", 2), ("Missing or incorrect version field (expected 1).",)),
    (_case("version", 1.0), ()),
    (_case("version", "1"), ("Missing or incorrect version field (expected 1).",)),
    (_case("metadata", "-"), ("Missing metadata object.",)),
    (_case("metadata.title", ""), ("Missing metadata.title.",)),
    (_case("metadata.filename_slug", "-"), ("Missing metadata.filename_slug.",)),
    (_case("metadata.filename_slug", "a_b"), (f"metadata.filename_slug must match {DATE}_authorsurname_short-title_explainer.",)),
    (_case("metadata.date_created", ""), ("Missing metadata.date_created.", f"metadata.date_created must equal {DATE}.")),
    (_case("metadata.date_created", "2025-01-01"), (f"metadata.date_created must equal {DATE}.",)),
    (_case("metadata.date_created", None), ("Missing metadata.date_created.",)),
    (_case("hero", None), ("Missing hero object.",)),
    (_case("hero.headline", 0), ("Missing hero.headline.",)),
    (_case("hero.headline_html", "-"), ("Missing hero.headline_html.",)),
    (_case("hero.subtitle", False), ("Missing hero.subtitle.",)),
    (_case("hero.publication_date", ""), ("Missing hero.publication_date.",)),
    (_case("hero.publication_date", "May 2024"), ('hero.publication_date must use the format "Published Month Year".',)),
    (_case("top_block", "-"), ("Missing top_block.",)),
    (_case("top_block.pills", []), ("top_block.pills is empty or missing.",)),
    (_case("top_block.pills", [GOOD["top_block"]["pills"][0]]), ("top_block.pills must contain between 2 and 6 pills.",)),
    (_case("top_block.pills.1", "x"), ("top_block.pills[1] is not an object.",)),
    (_case("top_block.pills.0.number", 3), ("top_block.pills[0].number is empty.",)),
    (_case("top_block.pills.0.description", " \n"), ("top_block.pills[0].description is empty.",)),
    (_case("top_block.pills.1.accent_color", "-"), ("top_block.pills[1].accent_color is empty.",)),
    (_case("top_block", {"kind": "takeaway"}) | {"end_takeaway": None}, ("top_block.body is empty (takeaway).",)),
    (_case("top_block", {"kind": "other"}), ('top_block.kind must be "pills" or "takeaway".',)),
)
#: Faults of sections and takeaways.
SECTION_CASES = (
    (_case("sections", []), ("Missing or empty sections array.",)),
    (_case("sections", "x"), ("Missing or empty sections array.",)),
    (_case("sections.0", 5), ("sections[0] is not an object.",)),
    (_case("sections.0.label", ""), ("sections[0] missing label.",)),
    (_case("sections.0.paragraphs", []), ("sections[0] must include paragraphs or a structured list.",)),
    (_case("sections.0.paragraphs", ["a", " "]), ("sections[0] contains empty paragraph entries.",)),
    (_case("sections.0.paragraphs_html", ["a", "b"]), ("sections[0].paragraphs_html must align with paragraphs length.",)),
    (_case("sections.0.list", {"ordered": "x", "items": [{"body": "b"}]}), ("sections[0].list.ordered must be boolean.",)),
    (_case("sections.0.list", {"ordered": True, "items": []}), ("sections[0].list.items must contain at least 1 item.",)),
    (_case("sections.0.list", {"ordered": True, "items": [1, {"body": ""}]}), ("sections[0].list.items[0] is not an object.", "sections[0].list.items[1].body is empty.")),
    (_case("top_block", {"kind": "takeaway", "body": "b"}), ('end_takeaway must be omitted when top_block.kind is "takeaway".',)),
    (_case("end_takeaway", "-"), ('end_takeaway must be present when top_block.kind is "pills".',)),
)
_CHART = {"title": "t", "caption": "c", "config_json": {"data": {"datasets": [{"data": [3.5, 7]}]}}}


def _data(*rows) -> dict:
    return _case("charts", [_CHART | {"config_json": {"data": {"datasets": [{"data": list(r)} for r in rows]}}}])


def _ordinal(d: int, shown: str) -> str:
    return f"charts[0].datasets[{d}].data is an ordinal sequence ({shown}) - bar height is encoding rank order, not magnitude. Move to a numbered list or prose, or replace with measured values."


def _share(d: int, shown: str, total: str) -> str:
    return f"charts[0].datasets[{d}].data is a two-value share-of-whole ({shown} sums to ~{total}). Move to top_block.pills - a proportion is not a chart."


#: Faults of charts, images and references.
REST_CASES = (
    (_case("charts", [_CHART]), ()),
    (_case("charts", {}), ("charts must be an array when present.",)),
    (_case("charts", [_CHART] * 5), ("charts must not contain more than 4 entries.",)),
    (_case("charts", [_CHART | {"title": " "}]), ("charts[0].title is empty.",)),
    (_case("charts", [7, _CHART | {"caption": None}]), ("charts[0].caption is empty.",)),
    (_case("chart", {"title": "t", "caption": "c"}), ("charts[0] must include config_json or config_raw.",)),
    (_case("chart", 1), ("chart must be an object when present.",)),
    (_data([1, 2, 3]), (_ordinal(0, "[1,2,3]"),)),
    (_data([3, 2, 1]), (_ordinal(0, "[3,2,1]"),)),
    (_data([], ["x", 0, 1, 2]), (_ordinal(0, "[0,1,2]"),)),
    (_data([5, 6, 7], [1, 2]), ()),
    (_data([1.6, 98.4]), (_share(0, "[1.6,98.4]", "100.00"),)),
    (_data([9, 4, 2], [0.3, 0.7]), (_share(1, "[0.3,0.7]", "1.00"),)),
    (_case("image", "x"), ("image must be an object when present.",)),
    (_case("image", {"source_figure": "", "caption": ""}), ("image.source_figure is empty.", "image.caption is empty.")),
    (_case("references", "-"), ("Missing references array.",)),
    (_case("references", []), ("references must contain the primary source citation.",)),
    (_case("references", [" ", 4]), ("references[0] is empty.", "references[1] is empty.")),
)


def _validated(spark: SparkSession, d: str, cases) -> DataFrame:
    records = F.array(*(F.lit(json.dumps(c)) for c, _ in cases))
    rows = table(spark, d, "documents").select("doc_id", validate.validation(J.extract_json(F.get(records, (F.col("doc_id") % len(cases)).cast("int"))), DATE).alias("x"))
    return rows.select("doc_id", "x.ok", F.array_join("x.issues", "; ").alias("issues"))


def _expected(cases) -> str:
    texts = ", ".join("'" + "; ".join(i).replace("'", "''") + "'" for _, i in cases)
    return f"SELECT doc_id, issues = '' AS ok, issues FROM (SELECT doc_id, ([{texts}])[doc_id % {len(cases)} + 1] AS issues FROM documents)"


@query(_expected(TOP_CASES))
def validate_scalar(spark: SparkSession, d: str) -> DataFrame:
    return _validated(spark, d, TOP_CASES)


@query(_expected(SECTION_CASES))
def validate_sections(spark: SparkSession, d: str) -> DataFrame:
    return _validated(spark, d, SECTION_CASES)


@query(_expected(REST_CASES))
def validate_rest(spark: SparkSession, d: str) -> DataFrame:
    return _validated(spark, d, REST_CASES)


_LISTS = """SELECT l_orderkey, list(l_linenumber::DOUBLE ORDER BY l_linenumber, l_partkey, l_quantity) AS a, list(l_quantity ORDER BY l_linenumber, l_partkey, l_quantity) AS q FROM lineitem GROUP BY l_orderkey"""


@query(f"""SELECT l_orderkey, len(a) >= 3 AND (a[1] IN (0, 1) OR a[-1] IN (0, 1)) AND (len(list_filter(range(2, len(a) + 1), lambda k: a[k] <> a[k - 1] + 1)) = 0 OR len(list_filter(range(2, len(a) + 1), lambda k: a[k] <> a[k - 1] - 1)) = 0) AS ordinal,
  len(q) = 2 AND (q[1] + q[2] BETWEEN 95 AND 105 OR q[1] + q[2] BETWEEN 0.95 AND 1.05) AS share FROM ({_LISTS})""")
def validate_charts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity"))).alias("x"))
    numbers = F.transform("x", lambda s: s["l_linenumber"].cast("double"))
    return rows.select("l_orderkey", validate.is_ordinal(numbers).alias("ordinal"), F.coalesce(validate.is_share(F.col("x.l_quantity")), F.lit(False)).alias("share"))


_REFS = """CASE page_id % 5 WHEN 0 THEN '<a href="' || url || '" target="_blank" rel="noopener noreferrer">p</a>' WHEN 1 THEN '<a href="' || url || '">p</a>' WHEN 2 THEN 'see ' || url
  WHEN 3 THEN '<A class="k" HREF=''' || url || ''' rel="nofollow noopener noreferrer" target="_blank">p</A> and ' || url ELSE '  ' END"""


@query("""SELECT page_id, page_id % 5 IN (0, 3) AS safe, page_id % 5 IN (2, 3) AS bare,
  CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'references[0] must include a clickable external anchor with target="_blank" and rel="noopener noreferrer".'
    WHEN 2 THEN 'references[0] must include a clickable external anchor with target="_blank" and rel="noopener noreferrer".; references[0] contains a bare URL outside an anchor tag.'
    WHEN 3 THEN 'references[0] contains a bare URL outside an anchor tag.' ELSE 'references[0] is empty.' END AS issues FROM pages""")
def validate_refs(spark: SparkSession, d: str) -> DataFrame:
    ref = F.expr(_REFS.replace("HREF=''' || url || '''", "HREF=\\'' || url || '\\'"))
    rows = table(spark, d, "pages").select("page_id", ref.alias("r"))
    blank = F.length(trim_all(F.col("r"))) == 0
    return rows.select("page_id", validate.safe_anchor(F.col("r")).alias("safe"), validate.bare_url(F.col("r")).alias("bare"), F.array_join(validate.reference_issues(F.col("r"), blank, F.lit(0)), "; ").alias("issues"))


@query(r"""WITH l AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: '<p>' || x || ' &amp;lt;</p>') AS rich, string_split(text, chr(10)) AS plain FROM documents),
  p AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN plain ELSE list_transform(plain, lambda x: regexp_replace(x || ' <', '^\s+', '')) END AS ps FROM l)
  SELECT doc_id, len(ps) AS n, md5(array_to_string(ps, chr(10))) AS digest, CASE WHEN doc_id % 3 = 0 THEN 'head' ELSE 'own' END AS label, CASE WHEN doc_id % 3 = 0 THEN 'a b' WHEN doc_id % 3 = 1 THEN 'x & y' ELSE 'kept' END AS body FROM p""")
def normalize_drift(spark: SparkSession, d: str) -> DataFrame:
    lines = F.split("text", "\n")
    rich = F.transform(lines, lambda x: F.concat(F.lit("<p>"), x, F.lit(" &amp;lt;</p>")))
    ends = F.array(F.lit('{"heading": "head", "paragraphs_html": ["<b>a</b>", " b "]}'), F.lit('{"label": "own", "heading": "h", "body_html": "<i>x</i> &amp; y"}'), F.lit('{"label": "own", "body": "kept", "body_html": "n"}'))
    end = normalize.takeaway(F.parse_json(F.get(ends, (F.col("doc_id") % 3).cast("int"))))
    ps = normalize.paragraphs(F.when(F.col("doc_id") % 2 == 0, lines), rich)
    return table(spark, d, "documents").select("doc_id", ps.alias("ps"), end.alias("e")).select("doc_id", F.size("ps").cast("bigint").alias("n"), F.md5(F.array_join("ps", "\n").cast("binary")).alias("digest"), "e.label", "e.body")


@query("""WITH o AS (SELECT l_orderkey, list('c' || l_linenumber || '-' || l_partkey ORDER BY l_linenumber, l_partkey) FILTER (WHERE l_linenumber % 2 = 1) AS c, count(*) AS n FROM lineitem GROUP BY l_orderkey)
  SELECT l_orderkey, array_to_string(CASE WHEN len(c) > 0 THEN c[1:3] WHEN n > 1 THEN ['legacy'] END, '|') AS kept, CASE WHEN len(c) > 0 THEN c[1] WHEN n > 1 THEN 'legacy' END AS first FROM o""")
def normalize_charts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("x"))
    charts = F.transform("x", lambda s: F.when(s["l_linenumber"] % 2 == 1, F.concat(F.lit("c"), s["l_linenumber"].cast("string"), F.lit("-"), s["l_partkey"].cast("string"))))
    kept = normalize.kept_charts(charts, F.when(F.size("x") > 1, "legacy"))
    return rows.select("l_orderkey", kept.alias("k")).select("l_orderkey", F.array_join("k", "|").alias("kept"), F.try_element_at("k", F.lit(1)).alias("first"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 0 WHEN doc_id % 3 = 1 THEN 1 ELSE 2 END AS repairs, doc_id % 3 <> 2 AS ok FROM documents")
def repair_loop(spark: SparkSession, d: str) -> DataFrame:
    from foliospark.plans.workflow import repair, stub_repair

    bad = [json.dumps(GOOD), json.dumps(_case("version", 2)), json.dumps(_case("sections", []))]
    rows = table(spark, d, "documents").select("doc_id", F.get(F.array(*(F.lit(x) for x in bad)), (F.col("doc_id") % 3).cast("int")).alias("text"))
    return repair(rows, DATE, stub_repair, lambda df: materialize(df, "repairs")).select("doc_id", "repairs", "ok")
