"""Mixing sources to target weights by hierarchical budgeting.

A token budget flows down a tree domain > language > source. Every node splits
its budget among its children by weight; a child cannot take more than its
documents give in the allowed number of epochs. What a child cannot take goes
to its siblings by weight, and only what a whole subtree lacks goes to the
siblings of an ancestor. Each leaf then takes whole epochs of its documents and
a token prefix of one more epoch, in an order seeded by epoch.

All amounts are integers (tokens; weights as integer parts), so shares round
down and the SQL form agrees to the token. The prefix is found digit by digit
of the order: tokens are summed up by the next digit, and only documents of the
digit where the prefix ends are looked at further, so no task sorts a leaf.

Defined results: null or empty text has 0 tokens and is never selected; null
domain, language or source form nodes of their own (as the text '?'); repeated
rows are separate documents, and equal places in the order follow by id and
tokens; a very long text counts as one document; an empty table selects nothing;
other columns are kept by ``select_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.llm.common import discard, materialize, table, text_or_empty

LEVELS = ("domain", "language", "origin")
#: Production parameters: budget as parts of all tokens (of 1000), most epochs,
#: seed, and digits of the order (of 48 bits) that are looked at one by one.
BUDGET_PARTS, MAX_EPOCHS, SEED = 600, 3, 17
DIGITS, DIGIT_BITS = 3, 6
#: Weights by level and name; other names weigh 1. Whole numbers up to 1000.
WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "language": {"en": 5, "de": 2, "fr": 2, "es": 1}, "origin": {}}
#: Sources fall into so many domains by their number (no number: domain d0).
DOMAINS = 4
SPACE = r"[^\x20\x09-\x0D]+"


def default_domain(source: Column) -> Column:
    """``d<k>`` for a source whose name ends in a number with remainder k."""
    return F.concat(F.lit("d"), (F.coalesce(F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("bigint"), F.lit(0)) % DOMAINS).cast("string"))


def count_words(text: Column) -> Column:
    """Tokens of a text: its whitespace-separated words."""
    return F.regexp_count(text, F.lit(SPACE)).cast("long")


def weight_of(level: str, weights: dict[str, dict[str, int]]) -> Column:
    known = weights.get(level, {})
    out = F.lit(1).cast("long")
    for name, w in known.items():
        out = F.when(F.col(level) == name, F.lit(int(w)).cast("long")).otherwise(out)
    return out


def split_budget(children: DataFrame, parents: list[str]) -> DataFrame:
    """Adds ``alloc``: shares of ``budget`` by weight ``w`` up to ``cap``.

    Children are taken by rising cap / w. One is full if its share of what the
    fuller ones leave exceeds its cap; the rest share what remains by weight.
    """
    order = Window.partitionBy(*parents).orderBy((F.col("cap") / F.col("w")).asc(), *(F.col(c) for c in LEVELS if c in children.columns and c not in parents))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rest = F.sum("w").over(onward)
    seen = children.withColumn("_left", left).withColumn("_rest", rest).withColumn("_full", F.col("_left") * F.col("w") >= F.col("cap") * F.col("_rest"))
    whole = Window.partitionBy(*parents)
    open_left = F.min(F.when(~F.col("_full"), F.col("_left"))).over(whole)
    first_open = F.max(F.when(~F.col("_full"), F.col("_rest"))).over(whole)
    kept = seen.withColumn("_open_rest", first_open).withColumn("_open_left", F.max(F.when(~F.col("_full") & (F.col("_rest") == F.col("_open_rest")), F.col("_left"))).over(whole))
    alloc = F.when(F.col("_full"), F.col("cap")).otherwise(F.expr("_open_left * w div _open_rest"))
    return kept.withColumn("alloc", alloc.cast("long")).drop("_left", "_rest", "_full", "_open_left", "_open_rest")


def allocate(leaves: DataFrame, weights: dict[str, dict[str, int]], budget_parts: int, max_epochs: int) -> DataFrame:
    """``domain, language, origin, tokens, alloc`` for every leaf.

    ``leaves`` holds one row per leaf, so windows here see nodes of the tree
    and never documents.
    """
    tree = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    budget = tree.agg((F.coalesce(F.sum("tokens"), F.lit(0)) * budget_parts).cast("long").alias("budget")).select(F.expr("budget div 1000").alias("budget"))
    path: list[str] = []
    above = budget.withColumn("_root", F.lit(1))
    for level in LEVELS:
        parents = path or ["_root"]
        path = [*path, level]
        nodes = tree.groupBy(*path).agg(F.sum("cap").cast("long").alias("cap")).withColumn("w", weight_of(level, weights)).withColumn("_root", F.lit(1))
        split = split_budget(nodes.join(above, parents), parents)
        above = split.select(*path, F.col("alloc").alias("budget"))
    return leaves.join(above, list(LEVELS)).select(*LEVELS, "tokens", F.col("budget").alias("alloc"))


def _prepared(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, domain: Column | None) -> DataFrame:
    named = docs.withColumns({"_id": F.col(id_col), "_origin": F.coalesce(F.col(source_col).cast("string"), F.lit("?")), "_language": F.coalesce(F.col(lang_col).cast("string"), F.lit("?")), "_tokens": count_words(text_or_empty(text_col))})
    return named.withColumn("_domain", F.coalesce(domain if domain is not None else default_domain(F.col("_origin")), F.lit("?")))


def plan_copies(docs: DataFrame, weights=None, budget_parts: int = BUDGET_PARTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", domain: Column | None = None) -> DataFrame:
    """``doc_id, domain, language, origin, n_tokens, n_copies`` per document
    (``n_copies`` 0 if it is not selected)."""
    weights = WEIGHTS if weights is None else weights
    rows = _prepared(docs, id_col, text_col, lang_col, source_col, domain).select(F.col("_id").alias("doc_id"), F.col("_domain").alias("domain"), F.col("_language").alias("language"), F.col("_origin").alias("origin"), F.col("_tokens").alias("n_tokens"))
    rows = materialize(rows, "mix-rows")
    leaves = materialize(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")).filter("tokens > 0"), "mix-leaves")
    alloc = allocate(leaves, weights, budget_parts, max_epochs).withColumns({"full": F.expr("alloc div tokens"), "part": F.expr("alloc % tokens")})
    alloc = materialize(alloc, "mix-alloc")
    placed = rows.filter("n_tokens > 0").join(alloc.select(*LEVELS, "full", "part"), list(LEVELS))
    # the order of the partial epoch: a hash of seed, epoch and id (as text)
    order = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("full").cast("string"), F.col("doc_id").cast("string"))), 1, 12), 16, 10).cast("long")
    placed = placed.withColumn("_at", order)
    # a leaf's edge: the digits of the place where its prefix ends (none: it takes all)
    edges = alloc.filter("part > 0").select(*LEVELS, "part", F.lit(0).cast("long").alias("_edge"), F.lit(0).cast("long").alias("_before"))
    for k in range(1, DIGITS + 1):
        digit = F.shiftright("_at", 48 - DIGIT_BITS * k)
        inside = placed.select(*LEVELS, "n_tokens", digit.alias("_place")).join(edges, list(LEVELS)).filter(F.shiftright("_place", DIGIT_BITS) == F.col("_edge"))
        sums = inside.groupBy(*LEVELS, "part", "_before", "_place").agg(F.sum("n_tokens").alias("n"))
        upto = F.col("_before") + F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("_place").rowsBetween(Window.unboundedPreceding, 0))
        cut = sums.withColumn("_upto", upto).filter("_upto > part and _upto - n <= part")
        old, edges = edges, materialize(cut.groupBy(*LEVELS, "part").agg(F.min(F.struct(F.col("_place").alias("p"), (F.col("_upto") - F.col("n")).alias("b"))).alias("x")).select(*LEVELS, "part", F.col("x.p").alias("_edge"), F.col("x.b").alias("_before")), f"mix-edge-{k}")
        discard(old)
    marked = placed.withColumn("_place", F.shiftright("_at", 48 - DIGIT_BITS * DIGITS)).join(edges.drop("part"), list(LEVELS), "left")
    ends = marked.filter("_place = _edge").withColumn("_sum", F.col("_before") + F.sum("n_tokens").over(Window.partitionBy(*LEVELS).orderBy("_at", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)))
    inner = ends.select("doc_id", *LEVELS, "n_tokens", (F.col("full") + F.when(F.col("_sum") <= F.col("part"), 1).otherwise(0)).alias("n_copies"))
    outer = marked.filter("_edge is null or _place <> _edge").select("doc_id", *LEVELS, "n_tokens", (F.col("full") + F.when((F.col("part") > 0) & (F.col("_edge").isNull() | (F.col("_place") < F.col("_edge"))), 1).otherwise(0)).alias("n_copies"))
    zero = rows.filter("n_tokens = 0").select("doc_id", *LEVELS, "n_tokens", F.lit(0).cast("long").alias("n_copies"))
    return inner.unionAll(outer).unionAll(zero)


def select_rows(docs: DataFrame, **params) -> DataFrame:
    """The selected documents with all their columns and ``n_copies`` (which
    takes the place of a column of that name).

    Rows that share an id share the larger number of copies.
    """
    id_col = params.get("id_col", "doc_id")
    chosen = plan_copies(docs, **params).filter("n_copies > 0").groupBy("doc_id").agg(F.max("n_copies").alias("n_copies"))
    chosen = chosen.withColumnRenamed("doc_id", "_key")
    return docs.join(chosen, docs[id_col].eqNullSafe(chosen["_key"])).select(*(docs[c] for c in docs.columns if c != "n_copies"), chosen["n_copies"])


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_copies(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    def weights(level: str) -> str:
        known = " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in WEIGHTS[level].items())
        return f"CASE {known} ELSE 1 END" if known else "1"

    def split(name: str, above: str, parents: list[str], level: str) -> str:
        path = ", ".join([*parents, level])
        join = f"USING ({', '.join(parents)})" if parents else "ON true"
        by = f"PARTITION BY {', '.join(parents)} " if parents else ""
        return f"""
{name}_n AS (SELECT {path}, sum(tokens * {MAX_EPOCHS})::BIGINT AS cap, {weights(level)} AS w FROM leaves GROUP BY {path}),
{name}_s AS (SELECT n.*, a.budget - coalesce(sum(cap) OVER (PRIOR), 0) AS rem, sum(w) OVER (ONWARD) AS rest FROM {name}_n n JOIN {above} a {join}),
{name}_o AS (SELECT *, rem * w >= cap * rest AS is_full FROM {name}_s),
{name}_p AS (SELECT *, max(CASE WHEN NOT is_full THEN rest END) OVER ({by}) AS open_rest FROM {name}_o),
{name}_q AS (SELECT *, max(CASE WHEN NOT is_full AND rest = open_rest THEN rem END) OVER ({by}) AS open_rem FROM {name}_p),
{name} AS (SELECT {path}, (CASE WHEN is_full THEN cap ELSE (open_rem * w)::HUGEINT // open_rest END)::BIGINT AS budget FROM {name}_q)""".replace(
            "PRIOR", f"{by}ORDER BY cap::DOUBLE / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        ).replace("ONWARD", f"{by}ORDER BY cap::DOUBLE / w, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING")

    return f"""
WITH rows_ AS (
  SELECT doc_id, coalesce(lang, '?') AS "language", coalesce(source, '?') AS origin,
    'd' || (coalesce(try_cast(regexp_extract(coalesce(source, '?'), '([0-9]{{1,9}})$', 1) AS BIGINT), 0) % {DOMAINS})::VARCHAR AS "domain",
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens
  FROM documents),
leaves AS (SELECT "domain", "language", origin, sum(n_tokens)::BIGINT AS tokens FROM rows_ GROUP BY ALL HAVING sum(n_tokens) > 0),
root AS (SELECT (sum(tokens) * {BUDGET_PARTS})::HUGEINT // 1000 AS budget FROM leaves),
{split("lv1", "root", [], "domain")},
{split("lv2", "lv1", ["domain"], "language")},
{split("lv3", "lv2", ["domain", "language"], "origin")},
alloc AS (SELECT "domain", "language", origin, budget // tokens AS whole_, budget % tokens AS part FROM lv3 JOIN leaves USING ("domain", "language", origin)),
placed AS (SELECT r.*, whole_, part, ('0x' || substr(md5('{SEED}:' || whole_ || ':' || doc_id), 1, 12))::BIGINT AS at_ FROM rows_ r JOIN alloc USING ("domain", "language", origin) WHERE n_tokens > 0),
summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY "domain", "language", origin ORDER BY at_, doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM placed)
SELECT doc_id, "domain", "language", origin, n_tokens, (whole_ + CASE WHEN part > 0 AND upto <= part THEN 1 ELSE 0 END)::BIGINT AS n_copies FROM summed
UNION ALL SELECT doc_id, "domain", "language", origin, n_tokens, 0::BIGINT FROM rows_ WHERE n_tokens = 0
"""


QUERIES = {"op6_source_mixing": op6_source_mixing}
ORACLES = {"op6_source_mixing": _oracle()}
