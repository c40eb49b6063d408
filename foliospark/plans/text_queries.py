"""Registered queries: text, identifiers, prompts and configuration.

Cases that the tables lack are made in the query from literals keyed by an id,
and in the same way in the SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions import jsonx as J
from foliospark.functions import text as T
from foliospark.operators import lanes, ledger
from foliospark.operators.validate import repair_instruction
from foliospark.plans.registry import query, table

#: What the registered SQL shares: outer white space goes; entities are decoded.
SPACE = r"'^\s+|\s+$'"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, {SPACE}, '', 'g')"


def _decoded(x: str) -> str:
    return f"""replace(replace(replace(replace(replace(replace({x}, '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', '''')"""


@query(rf"""
WITH s AS (SELECT page_id, regexp_replace(substr(html, 1, 600000), '(?i)<script[^>]*>[\s\S]*?</script>|<style[^>]*>[\s\S]*?</style>', ' ', 'g') AS h FROM pages),
  t AS (SELECT page_id, regexp_replace(regexp_replace(h, '<!--[\s\S]*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g') AS h FROM s),
  d AS (SELECT page_id, regexp_replace({_decoded("h")}, '\s{{2,}}', ' ', 'g') AS h FROM t)
SELECT page_id, substr({_trim("h")}, 1, 200000) AS body FROM d
""")
def strip_html(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", T.page_text(F.col("html")).alias("body"))


@query(f"""
WITH t AS (SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS h FROM pages),
  d AS (SELECT page_id, {_decoded("h")} AS h FROM t)
SELECT page_id, {_trim("h")} AS body FROM d
""")
def html_to_plain(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", T.html_to_plain(F.col("html")).alias("body"))


@query("SELECT page_id, 'explainer-url-' || substr(regexp_replace(regexp_replace(url, '^https?://', ''), '[^a-zA-Z0-9_-]', '-', 'g'), 1, 80) AS custom_id FROM pages")
def url_custom_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", T.url_custom_id(F.col("url")).alias("custom_id"))


@query("SELECT doc_id, substr('explainer-' || regexp_replace(regexp_replace(source || ' v' || doc_id || ' (draft).PDF', '(?i)\\.pdf$', ''), '[^a-zA-Z0-9_-]', '-', 'g'), 1, 64) AS custom_id FROM documents")
def doc_custom_id(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat("source", F.lit(" v"), F.col("doc_id").cast("string"), F.lit(" (draft).PDF"))
    return table(spark, d, "documents").select("doc_id", T.pdf_custom_id(name).alias("custom_id"))


_URL_CASES = {0: "concat(url, '.PDF?x=1')", 1: "'https://arxiv.org/pdf/' || page_id", 2: "concat(url, '?f=a.pdf')"}
_URL_SQL = "CASE page_id % 4 " + " ".join(f"WHEN {k} THEN {v}" for k, v in _URL_CASES.items()) + " ELSE url END"


@query(f"SELECT page_id, u AS url FROM (SELECT page_id, {_URL_SQL} AS u FROM pages) WHERE split_part(lower(u), '?', 1) LIKE '%.pdf' OR contains(split_part(lower(u), '?', 1), 'arxiv.org/pdf/')")
def pdf_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.expr(_URL_SQL).alias("url")).filter(T.is_pdf_url(F.col("url")))


_LINES = "CASE page_id % 5 WHEN 0 THEN '  # a comment' WHEN 1 THEN '   ' WHEN 2 THEN url || '  # Focus : look at page ' || page_id ELSE '  ' || url END"


@query(f"""SELECT page_id, CASE WHEN regexp_matches(l, '(?i)^(\\S+)\\s+#\\s*focus\\s*:\\s*(.+)$') THEN regexp_extract(l, '(?i)^(\\S+)\\s+#\\s*focus\\s*:\\s*(.+)$', 1) ELSE l END AS url,
  CASE WHEN regexp_matches(l, '(?i)^(\\S+)\\s+#\\s*focus\\s*:\\s*(.+)$') THEN regexp_extract(l, '(?i)^(\\S+)\\s+#\\s*focus\\s*:\\s*(.+)$', 2) END AS note
  FROM (SELECT page_id, {_trim('(' + _LINES + ')')} AS l FROM pages) WHERE l <> '' AND NOT starts_with(l, '#')""")
def url_line_parse(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "pages").select("page_id", T.trim_all(F.expr(_LINES)).alias("l")).filter(~T.is_comment_or_blank(F.col("l")))
    return lines.withColumn("x", T.split_url_line(F.col("l"))).select("page_id", "x.url", "x.note")


#: Notes by id, and what they say: hint, figure, caption, alt text, page.
NOTES = (
    ("IMAGE : fig. 4a\nimage_caption: The model \nimage-page-hint: 12 pages", None, "Figure 4a", "The model", None, 12),
    ("read this\nimage: Fig.3\nimage_alt:  A plot\nand this", "read this\nand this", "Fig.3", None, "A plot", None),
    ("image: figure   2\nimage_page_hint: x", None, "Figure   2", None, None, None),
    ("image: Figure three\nimage_caption: lost", "image: Figure three", None, None, None, None),
    ("image_page_hint: 3", None, None, None, None, None),
    ("image: figure 1\nimage: fig 2.5\nimage_page_hint: 7\nimage_page_hint: -1\nimage_caption: a\nimage_caption: b", None, "Figure 2.5", "b", None, 7),
    ("   ", None, None, None, None, None),
)


def _list(values, kind: str) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" if kind == "VARCHAR" else str(v) for v in values) + f"]::{kind}[]"


def _pick(index: int, kind: str = "VARCHAR") -> str:
    return f"({_list([n[index] for n in NOTES], kind)})[doc_id % {len(NOTES)} + 1]"


@query(f"SELECT doc_id, {_pick(1)} AS hint, {_pick(2)} AS source_figure, {_pick(3)} AS caption, {_pick(4)} AS alt_text, {_pick(5, 'INTEGER')} AS page_hint FROM documents")
def focus_directives(spark: SparkSession, d: str) -> DataFrame:
    notes = F.array(*(F.lit(n[0]) for n in NOTES))
    found = T.focus_directives(F.get(notes, (F.col("doc_id") % len(NOTES)).cast("int")))
    return table(spark, d, "documents").withColumn("x", found).select("doc_id", "x.*")


@query("""SELECT n_nationkey, coalesce(CASE WHEN n_nationkey % 3 = 0 THEN 'env-' || n_name END, CASE WHEN n_nationkey % 2 = 0 THEN 'file-' || n_name END, 'default') AS model,
  CASE WHEN n_nationkey % 4 = 0 THEN n_nationkey * 100 WHEN n_nationkey % 5 = 0 THEN 2048 ELSE 8192 END::BIGINT AS max_tokens FROM nation""")
def config_coalesce(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "nation")
    env = base.filter("n_nationkey % 3 = 0").select("n_nationkey", F.concat(F.lit("env-"), "n_name").alias("env_model"))
    limit = base.select("n_nationkey", F.when(F.col("n_nationkey") % 4 == 0, F.concat((F.col("n_nationkey") * 100).cast("string"), F.lit(".7"))).when(F.col("n_nationkey") % 7 == 0, "-3").otherwise("many").alias("env_limit"))
    file = base.filter("n_nationkey % 2 = 0").select("n_nationkey", F.concat(F.lit("file-"), "n_name").alias("file_model"))
    sizes = base.filter("n_nationkey % 5 = 0").select("n_nationkey", F.lit(2048).cast("bigint").alias("file_limit"))
    joined = base.join(env, "n_nationkey", "left").join(limit, "n_nationkey", "left").join(file, "n_nationkey", "left").join(sizes, "n_nationkey", "left")
    return joined.select("n_nationkey", F.coalesce("env_model", "file_model", F.lit("default")).alias("model"), T.positive_int(F.col("env_limit"), F.coalesce("file_limit", F.lit(8192))).cast("bigint").alias("max_tokens"))


_LANE_LIST = ", ".join(f"'{x}'" for x in lanes.LANES)


@query(f"""SELECT doc_id, lane, 'Extract the "' || lane || '" lane from this paper.' || chr(10) || 'Write 4-8 short bullets as plain text.' || chr(10) || 'Prioritize empirical evidence and key results where relevant.' AS prompt,
  'You are extracting structured evidence from one research paper.' || chr(10) || 'Focus lane: ' || lane || '.' || chr(10) || 'Return concise plain text only. Include direct quantitative findings when available.' || chr(10) || 'Do not produce HTML.' AS instruction,
  md5('- first ' || doc_id || chr(10) || '- second') AS issue_digest
  FROM documents CROSS JOIN (SELECT unnest([{_LANE_LIST}]) AS lane)""")
def prompt_render(spark: SparkSession, d: str) -> DataFrame:
    from foliospark.operators import prompts

    rows = table(spark, d, "documents").select("doc_id", F.explode(F.array(*(F.lit(x) for x in lanes.LANES))).alias("lane"))
    found = F.array(F.concat(F.lit("first "), F.col("doc_id").cast("string")), F.lit("second"))
    text = F.split(repair_instruction(found, "2026-01-01"), "\n")
    return rows.select("doc_id", "lane", prompts.lane_prompt(F.col("lane")).alias("prompt"), prompts.lane_instruction(F.col("lane")).alias("instruction"), F.md5(F.array_join(F.filter(text, lambda x: x.startswith("- ")), "\n").cast("binary")).alias("issue_digest"))


@query(f"SELECT 'explainer-' || doc_id AS custom_id, lane, 'explainer-' || doc_id || '::lane::' || lane AS lane_id FROM documents CROSS JOIN (SELECT unnest([{_LANE_LIST}]) AS lane)")
def lane_fanout(spark: SparkSession, d: str) -> DataFrame:
    return lanes.fan_out(table(spark, d, "documents").select(F.concat(F.lit("explainer-"), F.col("doc_id").cast("string")).alias("custom_id")))


@query(f"""WITH r AS (SELECT conv_id, turn, ([{_LANE_LIST}])[turn % 4 + 1] AS lane, text FROM conversations),
  l AS (SELECT conv_id, lane, arg_max(coalesce(text, ''), turn) AS t FROM r GROUP BY ALL),
  p AS (SELECT conv_id, {", ".join(f"max(CASE WHEN lane = '{x}' THEN t END) AS {x}" for x in lanes.LANES)} FROM l GROUP BY conv_id)
  SELECT 'explainer-' || conv_id AS base, {" || chr(10) || chr(10) || ".join(f"'## {x}' || chr(10) || coalesce({x}, '(missing)')" for x in lanes.LANES)} AS body,
  concat_ws(',', {", ".join(f"CASE WHEN {x} IS NULL THEN '{x}' END" for x in lanes.LANES)}) AS missing FROM p""")
def lane_fanin(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(*(F.lit(x) for x in lanes.LANES))
    base = F.concat(F.lit("explainer-"), F.col("conv_id").cast("string"))
    rows = table(spark, d, "conversations").select(T.lane_id(base, F.get(names, F.col("turn") % 4)).alias("lane_id"), "text", "turn")
    return lanes.fan_in(rows, "turn")


@query("SELECT doc_id, 'errored' AS result, 'No lane outputs available for synthesis' AS error FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def lane_missing_errored(spark: SparkSession, d: str) -> DataFrame:
    return lanes.without_lanes(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id"), "doc_id")


#: Texts around a record, and whether they yield one.
_WRAP = (
    "'Sure, here it is: ' || j || ' Done.'",
    "'```json' || chr(10) || j || chr(10) || '``` and more }'",
    "j || ' foo ' || j",
    "'no record at all'",
    "'  ' || j || chr(10)",
    "'```JSON' || chr(10) || j || chr(10) || '```'",
)
_RECORD = "'{\"id\": ' || doc_id || ', \"n\": {\"chars\": ' || n_chars || '}}'"
_RAW = "CASE doc_id % 6 " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(_WRAP)) + " END"


@query(f"""SELECT doc_id, doc_id % 6 NOT IN (2, 3) AS ok, CASE WHEN doc_id % 6 NOT IN (2, 3) THEN doc_id END::BIGINT AS id, CASE WHEN doc_id % 6 NOT IN (2, 3) THEN n_chars END::BIGINT AS chars FROM documents""")
def extract_json(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "documents").select("doc_id", F.expr(_RECORD).alias("j"), "n_chars").withColumn("raw", F.expr(_RAW))
    v = raw.select("doc_id", J.extract_json(F.col("raw")).alias("v"))
    return v.select("doc_id", F.col("v").isNotNull().alias("ok"), F.try_variant_get("v", "$.id", "bigint").alias("id"), F.try_variant_get("v", "$.n.chars", "bigint").alias("chars"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'x' || doc_id || '.json' WHEN doc_id % 3 = 1 THEN 'a-b' || doc_id || '.json' ELSE '2026-01-01_' || substr(source || '-' || doc_id, 1, 50) || '_explainer.json' END AS name,
  CASE WHEN doc_id % 3 = 0 THEN 'x' || doc_id || '.html' WHEN doc_id % 3 = 1 THEN 'a-b' || doc_id || '.html' ELSE '2026-01-01_' || substr(source || '-' || doc_id, 1, 50) || '_explainer.html' END AS page FROM documents""")
def output_filename(spark: SparkSession, d: str) -> DataFrame:
    slug = F.expr("CASE doc_id % 3 WHEN 0 THEN concat('x', doc_id, '.json') WHEN 1 THEN concat('a/b', doc_id) WHEN 2 THEN '' END")
    rows = table(spark, d, "documents").select("doc_id", T.output_filename(slug, F.expr("concat('explainer-url-', source, '-', doc_id)"), "2026-01-01").alias("name"))
    return rows.withColumn("page", T.html_name(F.concat(F.lit("/out/"), "name")))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN regexp_replace(text, '^\\s+', '') WHEN 2 THEN '---' || chr(10) || 'open: ' || text ELSE '' END AS body FROM documents")
def frontmatter(spark: SparkSession, d: str) -> DataFrame:
    raw = F.expr("CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN concat('---\\na: b\\n ---\\n\\n', text) WHEN 2 THEN concat('---\\nopen: ', text) ELSE '---\\n---' END")
    return table(spark, d, "documents").select("doc_id", T.strip_frontmatter(raw).alias("body"))


@query(r"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ls FROM documents),
  n AS (SELECT doc_id, len(ls) AS n, len(list_filter(ls, lambda x: regexp_matches(x, '^#\s+\S') OR regexp_matches(x, '^\w[\w.]*\s*=\s*\S') OR regexp_matches(x, '\bdef\s+\w+\s*\(') OR regexp_matches(x, '\bimport\s+\w+') OR regexp_matches(x, '^[a-z_]\w*\(.*\)\s*[{;]?$'))) AS code,
    coalesce(list_sum(list_transform(ls, lambda x: len(list_filter(regexp_split_to_array(x, '\s+'), lambda w: w <> '')))), 0) AS words FROM l)
  SELECT doc_id, CASE WHEN n < 8 THEN false WHEN code / n > 0.25 THEN true ELSE n >= 30 AND words / n >= 7 END AS heavy FROM n""")
def code_density(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.is_code_or_prose(F.col("text")).alias("heavy"))


@query("SELECT DISTINCT text FROM documents ORDER BY text")
def dedupe_sorted(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("text").distinct().orderBy("text")


@query("SELECT d.doc_id, sha256(d.text) AS sha256, CASE WHEN b.h = sha256(d.text) THEN 'reuse' ELSE 'upload' END AS action, CASE WHEN b.h = sha256(d.text) THEN 'file-' || d.doc_id END AS file_id FROM documents d LEFT JOIN (SELECT doc_id, sha256(CASE WHEN doc_id % 3 = 0 THEN 'stale' ELSE text END) AS h FROM documents WHERE doc_id % 2 = 0) b USING (doc_id)")
def file_cache_lookup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    cache = docs.filter("doc_id % 2 = 0").select("doc_id", F.sha2(F.expr("CASE WHEN doc_id % 3 = 0 THEN 'stale' ELSE text END").cast("binary"), 256).alias("sha256"), F.concat(F.lit("file-"), F.col("doc_id").cast("string")).alias("file_id"))
    return ledger.file_cache_action(docs.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256")), cache, "doc_id").select("doc_id", "sha256", "action", "file_id")
