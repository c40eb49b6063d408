"""Registered queries: ledger reports, costs, joins and geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators import figures, ledger, pricing
from foliospark.plans.registry import query, table

_PRICES = "(VALUES " + ", ".join(f"('{p}', '{m}', {i}, {o})" for p, m, i, o in pricing.PRICES) + ") AS p(provider, model, price_in, price_out)"
_MODEL = "CASE lang WHEN 'en' THEN 'claude-opus-4-8' WHEN 'fr' THEN 'claude-haiku-4-5' WHEN 'de' THEN 'gpt-5.4-mini' ELSE 'unknown' END"
_PROVIDER = "CASE lang WHEN 'de' THEN 'openai' ELSE 'claude' END"


def _round4(x: str) -> str:
    return f"floor(({x}) * 10000 + 0.5) / 10000"


_STD = "input_tokens / 1e6::DOUBLE * coalesce(price_in, 0)::DOUBLE + output_tokens / 1e6::DOUBLE * coalesce(price_out, 0)::DOUBLE"
_USAGE = f"""SELECT u.*, {_round4("std")} AS standard_cost_usd, {_round4("std * (1 - rate)")} AS batch_cost_usd, {_round4("std - std * (1 - rate)")} AS saving_usd
  FROM (SELECT u.*, {_STD} AS std, CASE WHEN is_batch THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS rate FROM U_ u LEFT JOIN {_PRICES} USING (provider, model)) u"""


@query(_USAGE.replace("SELECT u.*, floor", "SELECT doc_id, provider, model, input_tokens, output_tokens, floor").replace("U_", f"(SELECT doc_id, {_PROVIDER} AS provider, {_MODEL} AS model, n_chars AS input_tokens, n_chars // 3 AS output_tokens, doc_id % 4 <> 0 AS is_batch FROM documents)"))
def cost_calc(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.expr(_PROVIDER).alias("provider"), F.expr(_MODEL).alias("model"), F.col("n_chars").alias("input_tokens"), F.expr("n_chars div 3").alias("output_tokens"), F.expr("doc_id % 4 <> 0").alias("b"))
    return pricing.with_cost(rows, F.col("b")).select("doc_id", "provider", "model", "input_tokens", "output_tokens", "standard_cost_usd", "batch_cost_usd", "saving_usd")


_TURN = """(SELECT conv_id, turn, 'openai' AS provider, CASE WHEN turn % 2 = 0 THEN 'gpt-5.4' ELSE 'gpt-5.4-mini' END AS model, length(text)::BIGINT AS input_tokens, (length(text) // 2)::BIGINT AS output_tokens, turn % 2 = 0 AS is_batch FROM conversations)"""


@query(f"""WITH c AS ({_USAGE.replace("U_", _TURN)}), p AS (SELECT a.conv_id, a.turn, a.input_tokens + coalesce(b.input_tokens, 0) AS input_tokens, a.output_tokens + coalesce(b.output_tokens, 0) AS output_tokens,
  a.standard_cost_usd + coalesce(b.standard_cost_usd, 0) AS standard_cost_usd, a.batch_cost_usd + coalesce(b.batch_cost_usd, 0) AS batch_cost_usd FROM c a LEFT JOIN c b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.turn % 2 = 0)
  SELECT *, standard_cost_usd - batch_cost_usd AS saving_usd FROM p""")
def usage_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.lit("openai").alias("provider"), F.when(F.col("turn") % 2 == 0, "gpt-5.4").otherwise("gpt-5.4-mini").alias("model"), F.length("text").cast("bigint").alias("input_tokens"), F.expr("cast(length(text) div 2 as bigint)").alias("output_tokens"))
    costed = pricing.with_cost(rows, F.col("turn") % 2 == 0)
    names = ("input_tokens", "output_tokens", "standard_cost_usd", "batch_cost_usd")
    base = costed.filter("turn % 2 = 0").select("conv_id", "turn", *names)
    repair = costed.filter("turn % 2 = 1").select("conv_id", (F.col("turn") - 1).alias("turn"), *(F.col(x).alias(f"r_{x}") for x in names))
    merged = pricing.merge_usage({x: F.col(x) for x in names}, {x: F.col(f"r_{x}") for x in names})
    return base.join(repair, ["conv_id", "turn"], "left").select("conv_id", "turn", *(v.alias(k) for k, v in merged.items()))


#: Ledger rows made from events: the user is the batch.
_LEDGER = {
    "type": "CASE WHEN event_type IN ('click', 'view') THEN 'lane' ELSE 'explainer' END",
    "result": "CASE event_id % 5 WHEN 0 THEN 'errored' WHEN 1 THEN 'pending' ELSE 'succeeded' END",
    "input_tokens": "CASE WHEN event_id % 5 <> 1 THEN cast(floor(value * 100) AS bigint) END",
    "output_tokens": "CASE WHEN event_id % 5 <> 1 THEN cast(floor(value * 10) AS bigint) END",
    "model": "CASE WHEN event_id % 3 = 0 THEN 'gpt-5.4' ELSE 'gpt-5.5' END",
    "provider": "'openai'",
    "is_batch": "event_id % 2 = 0",
}


def _requests(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.col("user_id").alias("batch_id"), "event_id", *(F.expr(v).alias(k) for k, v in _LEDGER.items()))
    costed = pricing.with_cost(rows, F.col("is_batch"))
    # sums of whole hundredths of a cent do not depend on the order
    return costed.withColumns({c: F.round(F.col(c) * 10000).cast("bigint") for c in ("standard_cost_usd", "batch_cost_usd", "saving_usd")})


_REQ = f"""(SELECT batch_id, event_id, type, result, input_tokens, output_tokens, round(standard_cost_usd * 10000)::BIGINT AS standard_cost_usd, round(batch_cost_usd * 10000)::BIGINT AS batch_cost_usd, round(saving_usd * 10000)::BIGINT AS saving_usd
  FROM ({_USAGE.replace("U_", "(SELECT user_id AS batch_id, event_id, " + ", ".join(f"{v} AS {k}" for k, v in _LEDGER.items()) + " FROM events)")}))"""
_STATUS = f"""SELECT batch_id, count(*) FILTER (WHERE type = 'explainer') AS n_total, count(*) FILTER (WHERE type = 'explainer' AND result = 'succeeded') AS n_succeeded, count(*) FILTER (WHERE type = 'explainer' AND result = 'errored') AS n_errored,
  count(*) FILTER (WHERE type = 'lane') AS n_lanes, coalesce(sum(input_tokens), 0)::BIGINT AS tokens_in, coalesce(sum(output_tokens), 0)::BIGINT AS tokens_out,
  coalesce(sum(batch_cost_usd), 0)::BIGINT AS effective_usd, coalesce(sum(standard_cost_usd), 0)::BIGINT AS standard_usd, coalesce(sum(saving_usd), 0)::BIGINT AS saving_usd FROM {_REQ} GROUP BY batch_id"""


@query(_STATUS)
def status_by_batch(spark: SparkSession, d: str) -> DataFrame:
    return ledger.batch_status(_requests(spark, d), "batch_id")


@query(f"SELECT sum(tokens_in)::BIGINT AS tokens_in, sum(tokens_out)::BIGINT AS tokens_out, sum(effective_usd)::BIGINT AS effective_usd, sum(standard_usd)::BIGINT AS standard_usd, (sum(standard_usd) - sum(effective_usd))::BIGINT AS saving_usd FROM ({_STATUS}) HAVING sum(effective_usd) > 0")
def status_grand_total(spark: SparkSession, d: str) -> DataFrame:
    return ledger.grand_total(ledger.batch_status(_requests(spark, d), "batch_id"))


@query(f"SELECT batch_id, sum(batch_cost_usd)::BIGINT AS effective_usd, sum(standard_cost_usd)::BIGINT AS standard_usd, sum(saving_usd)::BIGINT AS saving_usd FROM {_REQ} WHERE input_tokens IS NOT NULL GROUP BY batch_id")
def cost_summary(spark: SparkSession, d: str) -> DataFrame:
    return ledger.cost_summary(_requests(spark, d), "batch_id")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events WHERE event_id % 3 <> 0) WHERE k = 1")
def latest_pending(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("user_id", "event_id", "event_type", F.when(F.col("event_id") % 3 != 0, "processing").otherwise("ended").alias("status"), F.struct("ts", "event_id").alias("seq"))
    return ledger.latest_pending(rows, "seq", "user_id").select("user_id", "event_id", "event_type")


@query("SELECT user_id, arg_max(props, (ts, event_id)) AS props FROM events WHERE event_id % 4 = 0 GROUP BY user_id")
def newest_override(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("user_id", F.when(F.col("event_id") % 4 == 0, F.col("props")).alias("props"), F.struct("ts", "event_id").alias("seq"))
    return ledger.newest(rows, "seq", "props", "user_id")


@query("SELECT o_orderkey, o_custkey, format('{:,}', floor(o_totalprice)::BIGINT) AS total FROM orders ORDER BY o_orderkey DESC")
def batch_listing(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.format_number(F.floor("o_totalprice"), 0).alias("total"))
    return ledger.listing(rows, "o_orderkey")


@query("SELECT doc_id, d.source, l.quality FROM documents d JOIN labels l USING (doc_id)")
def result_join(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'pending' WHEN quality = 0 THEN 'errored' ELSE 'succeeded' END AS result, CASE WHEN quality = 0 THEN CASE WHEN toxic = 1 THEN 'toxic' ELSE 'Unknown error' END END AS error FROM documents d LEFT JOIN labels l USING (doc_id)")
def pending_after_end(spark: SparkSession, d: str) -> DataFrame:
    results = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 0, "errored").otherwise("succeeded").alias("outcome"), F.when(F.col("toxic") == 1, "toxic").alias("message"))
    return ledger.apply_results(table(spark, d, "documents").select("doc_id"), results, "doc_id").select("doc_id", "result", "error")


@query("SELECT event_id, event_type, 'output' AS origin FROM events WHERE event_id % 3 <> 0 UNION ALL SELECT event_id, NULL, 'errors' FROM events WHERE event_id % 3 = 0")
def union_results(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("event_id", "event_type")
    output = events.filter("event_id % 3 <> 0").withColumn("origin", F.lit("output"))
    errors = events.filter("event_id % 3 = 0").select("event_id", F.lit("errors").alias("origin"))
    return output.unionByName(errors, allowMissingColumns=True)


@query("SELECT event_type, sum(CASE WHEN event_id % 7 <> 0 THEN (props->>'k')::BIGINT ELSE 0 END)::BIGINT AS tokens, count(*) FILTER (WHERE event_id % 7 = 0) AS bad_lines FROM events GROUP BY event_type")
def event_usage(spark: SparkSession, d: str) -> DataFrame:
    line = F.when(F.col("event_id") % 7 == 0, F.concat("props", F.lit("}{"))).otherwise(F.col("props"))
    from foliospark.functions.jsonx import parse_strict

    rows = table(spark, d, "events").select("event_type", parse_strict(line).alias("v"))
    return rows.groupBy("event_type").agg(F.sum(F.coalesce(F.try_variant_get("v", "$.k", "bigint"), F.lit(0))).alias("tokens"), F.count_if(F.col("v").isNull()).alias("bad_lines"))


@query("""SELECT user_id, CASE WHEN user_id % 5 IN (0, 1, 2, 3) THEN 'ended' ELSE 'in_progress' END AS status, greatest(count(*) - count(*) FILTER (WHERE event_id % 5 > 1) - count(*) FILTER (WHERE event_id % 5 = 0), 0) AS processing FROM events GROUP BY user_id""")
def remote_status(spark: SparkSession, d: str) -> DataFrame:
    state = F.get(F.array(*(F.lit(x) for x in (*ledger.ENDED, "in_progress"))), (F.col("user_id") % 5).cast("int"))
    sums = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_id") % 5 > 1).alias("ok"), F.count_if(F.col("event_id") % 5 == 0).alias("bad"))
    return sums.select("user_id", ledger.remote_status(state, F.col("n"), F.col("ok"), F.col("bad")).alias("x")).select("user_id", "x.*")


#: Fold of sorted values: a row is kept beyond 3 points of the last kept one.
_ROWS = """WITH RECURSIVE v AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value) AS k FROM events),
  f AS (SELECT user_id, k, value AS kept, true AS is_row FROM v WHERE k = 1 UNION ALL
    SELECT v.user_id, v.k, CASE WHEN v.value - f.kept > 3 THEN v.value ELSE f.kept END, v.value - f.kept > 3 FROM f JOIN v ON v.user_id = f.user_id AND v.k = f.k + 1),
  r AS (SELECT user_id, kept AS y, row_number() OVER (PARTITION BY user_id ORDER BY kept) AS i FROM f WHERE is_row)"""


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("user_id").agg(figures.bucket_rows(F.collect_list("value")).alias("rows"))


@query(f"{_ROWS} SELECT user_id, y FROM r")
def bucket_rows(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).select("user_id", F.explode("rows").alias("y"))


@query(f"""{_ROWS}, g AS (SELECT user_id, y, i, lead(y) OVER (PARTITION BY user_id ORDER BY i) - y AS gap FROM r),
  b AS (SELECT user_id, max(y) AS last, coalesce(max(gap), 0) AS best FROM g GROUP BY user_id)
  SELECT user_id, CASE WHEN last + 20 - 8 - last > best THEN greatest(0, last + 12) WHEN best >= 25 THEN least(last + 20, (SELECT min(y) FROM g WHERE g.user_id = b.user_id AND g.gap = b.best) + 12) END AS top FROM b""")
def gap_above(spark: SparkSession, d: str) -> DataFrame:
    caption = F.element_at("rows", -1) + 20
    return _rows(spark, d).select("user_id", figures.gap_above(F.col("rows"), caption).alias("top"))


@query(f"""{_ROWS}, g AS (SELECT user_id, y, i, y - lag(y) OVER (PARTITION BY user_id ORDER BY i) AS gap FROM r)
  SELECT user_id, CASE WHEN arg_min(y, i) FILTER (WHERE i > 5 AND gap >= 25) IS NOT NULL THEN greatest(min(y) - 30, arg_min(y, i) FILTER (WHERE i > 5 AND gap >= 25) - 12) END AS bottom FROM g GROUP BY user_id""")
def gap_below(spark: SparkSession, d: str) -> DataFrame:
    caption = F.element_at("rows", 1) - 30
    return _rows(spark, d).select("user_id", figures.gap_below(F.col("rows"), caption, F.lit(9999.0)).alias("bottom"))


#: Words made from line items: ten pages, two columns by the parity of a key.
_WORDS = {"page": "l_suppkey % 10", "x_min": "CASE WHEN l_partkey % 2 = 0 THEN 60 + l_quantity * 4 ELSE 330 + l_quantity * 4 END + l_linenumber / 8.0D", "x_max": "CASE WHEN l_partkey % 2 = 0 THEN 60 + l_quantity * 4 ELSE 330 + l_quantity * 4 END + 20"}
_WORDS_SQL = "(SELECT " + ", ".join(f"{v.replace('8.0D', '8.0::DOUBLE')} AS {k}" for k, v in _WORDS.items()) + " FROM lineitem)"
_HIST = f"""WITH w AS {_WORDS_SQL}, c AS (SELECT page, floor((x_min + x_max) / 2 / 6)::INTEGER AS bin, count(*) AS n FROM w WHERE (x_min + x_max) / 2 BETWEEN 0 AND 611.9999 GROUP BY ALL),
  h AS (SELECT page, bin, coalesce(n, 0) AS n FROM (SELECT DISTINCT page FROM w) CROSS JOIN (SELECT unnest(range(0, 102))::INTEGER AS bin) LEFT JOIN c USING (page, bin))"""
_GUTTER = f"""{_HIST}, l AS (SELECT *, n <= greatest(1, sum(n) OVER (PARTITION BY page) / 102 * 0.2) AS low FROM h),
  i AS (SELECT *, sum(CASE WHEN low THEN 0 ELSE 1 END) OVER (PARTITION BY page ORDER BY bin) AS run FROM l WHERE bin >= 51 - 14 AND bin < 51 + 14),
  s AS (SELECT page, min(bin) AS a, max(bin) + 1 AS b FROM i WHERE low GROUP BY page, run),
  g AS (SELECT page, arg_max(a, (b - a, -a)) * 6 AS gutter_start, arg_max(b, (b - a, -a)) * 6 AS gutter_end FROM s GROUP BY page HAVING max(b - a) * 6 >= 30)"""


def _words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(*(F.expr(v).alias(k) for k, v in _WORDS.items()))


def _bins(words: DataFrame) -> DataFrame:
    return figures.column_bins(words, ["page"], (F.col("x_min") + F.col("x_max")) / 2, F.lit(612.0))


@query(f"{_HIST} SELECT page, bin, n FROM h")
def column_histogram(spark: SparkSession, d: str) -> DataFrame:
    return _bins(_words(spark, d))


@query(f"{_GUTTER} SELECT page, gutter_start, gutter_end FROM g")
def gutter_islands(spark: SparkSession, d: str) -> DataFrame:
    return figures.gutters(_bins(_words(spark, d)), ["page"], F.lit(612.0))


@query(f"""{_GUTTER}, k AS (SELECT page, count(*) FILTER (WHERE (x_min + x_max) / 2 < gutter_start) AS n_left, count(*) FILTER (WHERE (x_min + x_max) / 2 > gutter_end) AS n_right,
  min(x_min) FILTER (WHERE (x_min + x_max) / 2 < gutter_start) AS left_min, max(x_max) FILTER (WHERE (x_min + x_max) / 2 < gutter_start) AS left_max,
  min(x_min) FILTER (WHERE (x_min + x_max) / 2 > gutter_end) AS right_min, max(x_max) FILTER (WHERE (x_min + x_max) / 2 > gutter_end) AS right_max FROM w JOIN g USING (page) GROUP BY page)
  SELECT *, abs(page * 60 - (left_min + left_max) / 2) <= abs(page * 60 - (right_min + right_max) / 2) AS caption_left FROM k WHERE n_left >= 20 AND n_right >= 20""")
def column_bounds(spark: SparkSession, d: str) -> DataFrame:
    words = _words(spark, d)
    found = figures.gutters(_bins(words), ["page"], F.lit(612.0))
    return figures.column_bounds(words, found, ["page"], "x_min", "x_max").withColumn("caption_left", figures.nearer_left(F.col("page") * 60))


_CROP = {"cx_min": "p_size * 4", "cy_min": "p_size * 2", "cx_max": "p_size * 4 + 200", "cy_max": "p_size * 2 + CASE WHEN p_partkey % 50 = 0 THEN 0 ELSE 100 END"}
_BOX = {"x_min": "l_quantity * 6", "y_min": "l_linenumber * 30", "x_max": "l_quantity * 6 + 40", "y_max": "l_linenumber * 30 + 12"}


@query(f"""WITH c AS (SELECT p_partkey AS page, {", ".join(f"({v})::BIGINT AS {k}" for k, v in _CROP.items())} FROM part), w AS (SELECT l_partkey AS page, {", ".join(f"({v})::BIGINT AS {k}" for k, v in _BOX.items())} FROM lineitem),
  j AS (SELECT c.page, (cx_max - cx_min) * (cy_max - cy_min) AS area, coalesce(sum(greatest(0, least(x_max, cx_max) - greatest(x_min, cx_min)) * greatest(0, least(y_max, cy_max) - greatest(y_min, cy_min))) FILTER (WHERE w.page IS NOT NULL), 0) AS covered FROM c LEFT JOIN w USING (page) GROUP BY ALL)
  SELECT page, CASE WHEN area > 0 THEN covered::DOUBLE / area ELSE 0 END AS ratio, CASE WHEN area > 0 THEN covered::DOUBLE / area ELSE 0 END > 0.3 AS mostly_text FROM j""")
def text_density(spark: SparkSession, d: str) -> DataFrame:
    crops = table(spark, d, "part").select(F.col("p_partkey").alias("page"), *(F.expr(v).cast("bigint").alias(k) for k, v in _CROP.items()))
    words = table(spark, d, "lineitem").select(F.col("l_partkey").alias("page"), *(F.expr(v).cast("bigint").alias(k) for k, v in _BOX.items()))
    return figures.text_density(words, crops, ["page"])


@query("""WITH b AS (SELECT p_partkey, p_size * 8.0 AS cap, CASE WHEN p_partkey % 3 = 0 THEN p_size * 3.0 END AS top, CASE WHEN p_partkey % 4 = 0 THEN p_size * 9.0 END AS bottom, CASE WHEN p_partkey % 2 = 0 THEN p_size * 1.0 END AS l, CASE WHEN p_partkey % 2 = 0 THEN p_size * 10.0 END AS r, p_partkey % 5 = 0 AS pinned FROM part),
  y AS (SELECT *, CASE WHEN pinned THEN 60 ELSE coalesce(top, greatest(0, cap - 8)) END AS y0, CASE WHEN pinned THEN greatest(61, cap - 4) ELSE coalesce(bottom, least(792, cap + 8)) END AS y1,
    CASE WHEN l IS NOT NULL AND least(612, r + 6) > greatest(0, l - 6) THEN greatest(0, l - 6) ELSE 0 END AS x0, CASE WHEN l IS NOT NULL AND least(612, r + 6) > greatest(0, l - 6) THEN least(612, r + 6) ELSE 612 END AS x1 FROM b),
  p AS (SELECT *, greatest(0, floor(x0::DOUBLE * (150 / 72::DOUBLE)))::BIGINT AS x, greatest(0, floor(y0::DOUBLE * (150 / 72::DOUBLE)))::BIGINT AS y_, ceil((y1 - y0)::DOUBLE * (150 / 72::DOUBLE))::BIGINT AS h FROM y WHERE y1 > y0)
  SELECT p_partkey, x, y_ AS y, least(1275 - x, ceil((x1 - x0)::DOUBLE * (150 / 72::DOUBLE))::BIGINT) AS w, h FROM p WHERE least(1275 - x, ceil((x1 - x0)::DOUBLE * (150 / 72::DOUBLE))::BIGINT) > 0 AND h > 0""")
def crop_pixels(spark: SparkSession, d: str) -> DataFrame:
    n = lambda k, m, f: F.when(F.col("p_partkey") % m == 0, F.col("p_size") * f) if m else F.col("p_size") * f
    box = figures.crop_box(F.col("p_size") * 8.0, n("t", 3, 3.0), n("b", 4, 9.0), F.lit(612.0), F.lit(792.0), n("l", 2, 1.0), n("r", 2, 10.0), F.col("p_partkey") % 5 == 0)
    rows = table(spark, d, "part").select("p_partkey", box.alias("b")).filter("b is not null")
    return rows.select("p_partkey", figures.crop_pixels(F.col("b"), F.lit(612.0)).alias("c")).filter("c is not null").select("p_partkey", "c.*")


_PAGES = ["text || CASE WHEN doc_id % 3 = 0 THEN ' see Figure 3 for' ELSE ' Figure 30. x' END", "'see fig. 3' || CASE WHEN doc_id % 4 = 0 THEN chr(10) || '  Fig.  3 : cap' ELSE ' and' END", "CASE WHEN doc_id % 2 = 0 THEN 'x' || chr(10) || 'Figure 3. The end' ELSE 'none' END"]


@query(f"""WITH p AS (SELECT doc_id, page, CASE page WHEN 1 THEN {_PAGES[0]} WHEN 2 THEN {_PAGES[1]} ELSE {_PAGES[2]} END AS t FROM documents CROSS JOIN (SELECT unnest([1, 2, 3]) AS page)),
  r AS (SELECT doc_id, page, CASE WHEN regexp_matches(t, '(?i)(^|\\n)\\s*(Figure|Fig\\.?)\\s+3\\s*[.:]') THEN 0 WHEN regexp_matches(t, '(?i)(^|\\s)(Figure|Fig\\.?)\\s+3($|[^0-9.]|.$|[0-9.][^0-9])') THEN 1 END AS k FROM p)
  SELECT doc_id, arg_min(page, (k, page)) AS page FROM r WHERE k IS NOT NULL GROUP BY doc_id""")
def figure_locate(spark: SparkSession, d: str) -> DataFrame:
    text = F.split(F.expr(" || chr(12) || ".join(f"({p})" for p in _PAGES)), "\f")
    pages = table(spark, d, "documents").select("doc_id", F.posexplode(text).alias("i", "t")).withColumn("page", F.col("i") + 1)
    return figures.locate_page(pages, "doc_id", "page", "t", F.lit("Fig. 3"))


@query("""WITH w AS (SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) - 1 AS seq FROM (SELECT doc_id, list_concat(string_split(text, ' '), CASE doc_id % 4 WHEN 0 THEN ['Figure', '2:'] WHEN 1 THEN ['fig.', '2'] WHEN 2 THEN ['Figure', '20'] ELSE ['x', '2', 'FIG', '2,b'] END) AS l FROM documents)),
  n AS (SELECT *, lead(word) OVER (PARTITION BY doc_id ORDER BY seq) AS next_ FROM w)
  SELECT doc_id, min(seq)::INTEGER AS seq FROM n WHERE regexp_matches(word, '(?i)^(figure|fig\\.?)$') AND regexp_matches(next_, '(?i)^2([.:,]|$)') GROUP BY doc_id""")
def caption_pair(spark: SparkSession, d: str) -> DataFrame:
    tail = F.expr("CASE doc_id % 4 WHEN 0 THEN array('Figure', '2:') WHEN 1 THEN array('fig.', '2') WHEN 2 THEN array('Figure', '20') ELSE array('x', '2', 'FIG', '2,b') END")
    words = table(spark, d, "documents").select("doc_id", F.posexplode(F.concat(F.split("text", " "), tail)).alias("seq", "word"))
    return figures.caption_words(words, ["doc_id"], "seq", "word", F.lit("2"))


_TIERS = """CASE n_nationkey % 6 WHEN 0 THEN 'gpt-5.4' WHEN 1 THEN 'gpt-5.4-mini' WHEN 2 THEN 'unknown' WHEN 3 THEN '' WHEN 4 THEN NULL ELSE 'gpt-5.5' END"""


@query(f"""WITH t AS (SELECT 'openai' AS provider, {_TIERS} AS model FROM nation), m AS (SELECT DISTINCT provider, model FROM t WHERE model <> '')
  SELECT (SELECT count(*) FROM t) + (SELECT count(*) FROM m) AS n_checks, (SELECT count(*) FROM t WHERE model IS NULL OR model = '') + (SELECT count(*) FROM m ANTI JOIN {_PRICES} USING (provider, model)) AS n_failed""")
def tier_check(spark: SparkSession, d: str) -> DataFrame:
    config = table(spark, d, "nation").select(F.lit("openai").alias("provider"), F.col("n_name").alias("tier"), F.expr(_TIERS).alias("model"))
    return pricing.tier_check(config)
