"""Personal data by information-theoretic sanitisation, in DataFrame functions.

Base entities (e-mail, IP address, card, phone) are found by pattern. Each
protects its value and the class that it is of (mail domain, network, area,
issuer). Corpus co-occurrence then estimates how strongly terms reveal them:

    disclosure(t, e) = PMI(t; e) / IC(e),  IC(e) = -log p(e)

is 1 when the term occurs with that entity only and 0 when they are
independent. Probabilities are shares of units: texts of at most UNIT_WORDS
words, or consecutive parts of so many. Terms beyond the threshold, seen with
the entity in enough different surroundings (near copies count as about one),
are sanitised wherever they occur. Base entities are generalised to their kind;
a term to its first letters, if those reveal less than the threshold allows,
else it is removed.

Defined results: null text counts as empty and has no spans; ``sanitise`` keeps
a null text null; repeated rows repeat, and count each, as near copies do; spans that begin together are ordered by kind; very long texts are scanned
whole, and counted unit by unit; an empty table gives an empty table; other
columns are ignored by ``find`` and kept by ``sanitise``. Offsets are code
points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.jsonx import let
from foliospark.llm.common import BROADCAST_IDS, discard, materialize, may_hold, table, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns with possessive quantifiers, and with a start only
#: where a run of its first class starts or the last match ended: the same
#: matches in linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
#: Words of a unit in which terms and entities occur together; least letters of
#: a term (in scripts without spaces, WIDE_LETTERS), and of its general form.
UNIT_WORDS, LEAST_LETTERS, WIDE_LETTERS, STEM = 512, 4, 2, 4
#: Least disclosure, and different surroundings with one entity, of a term.
DISCLOSURE, LEAST_CONTEXTS = 0.8, 3
WORD = r"[\p{L}\p{N}_]+"
TERM = rf"^(?:\p{{L}}{{{LEAST_LETTERS},}}|[\p{{IsHan}}\p{{IsHiragana}}\p{{IsKatakana}}\p{{IsHangul}}\p{{IsThai}}]{{{WIDE_LETTERS},}})$"
#: Pieces that a fold goes over at a time, so that it stays linear.
FOLD = 512


def _located(text: Column, pattern: str | Column, keep=lambda value: F.lit(True)) -> Column:
    """Matches of ``pattern`` as an array of (start, end, value).

    One pass of the pattern puts marks around the matches; a split at the marks
    gives gaps and matches in turn, whose lengths add up to positions.
    """
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    parts = F.split(F.regexp_replace(F.translate(text, "\x01", "\x02"), pattern, F.lit("\x01$0\x01")), "\x01", -1)

    def of_blocks(blocks: Column) -> Column:
        sizes = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + F.length(x)))
        return let(F.aggregate(sizes, F.array(F.lit(0)), lambda at, n: F.concat(at, F.array(F.element_at(at, -1) + n))), lambda first: F.flatten(F.transform(blocks, lambda b, k: of_block(b, F.get(first, k)))))

    def of_block(block: Column, first: Column) -> Column:
        # a block has an even number of pieces, so its matches are the odd ones
        zero = F.struct(first.alias("at"), F.lit(False).alias("odd"), none.alias("found"))

        def step(acc: Column, x: Column) -> Column:
            end = acc["at"] + F.length(x)
            one = F.array(F.struct(acc["at"].alias("start"), end.alias("end"), x.alias("value")))
            return F.struct(end.alias("at"), (~acc["odd"]).alias("odd"), F.when(acc["odd"] & keep(x), F.concat(acc["found"], one)).otherwise(acc["found"]).alias("found"))

        return F.aggregate(block, zero, step, lambda acc: acc["found"])

    blocks = lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / FOLD).cast("int")), lambda k: F.slice(p, k * FOLD + 1, F.lit(FOLD)))
    return let(parts, lambda p: F.when(F.size(p) > 1, let(blocks(p), of_blocks)).otherwise(none))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = _digits(value)
    size = F.length(digits)

    def add(total: Column, k: Column) -> Column:
        d = F.substring(digits, size - k, F.lit(1)).cast("int") * (1 + k % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return size.between(14, 19) & (F.when(size.between(14, 19), F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), add)).otherwise(1) % 10 == 0)


VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(F.split(v, r"\."), lambda part: part.cast("double") <= 255),
    "card": _luhn,
    "phone": lambda v: F.length(_digits(v)).between(10, 15),
}


def _spans(kind: str, text: Column) -> Column:
    """(start, kind order, end, kind, value) of the kind's matches."""
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")
    found = F.transform(_located(text, PATTERNS[kind], VALID[kind]), lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value")))
    has = F.contains(text, F.lit(HINTS[kind])) if HINTS[kind] else F.lit(True)
    if kind in ("ip", "card", "phone"):
        has = has & text.rlike("[0-9]")
    return F.when(has, found).otherwise(none)


def with_spans(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds ``_base``: all base spans by start, then kind."""
    kinds = docs.withColumns({f"_{k}": _spans(k, F.col(text_col)) for k in KINDS})
    return kinds.withColumn("_base", F.array_sort(F.concat(*(F.col(f"_{k}") for k in KINDS)))).drop(*(f"_{k}" for k in KINDS))


def _terms(text: Column) -> Column:
    """Terms of a text in order; words of base entities are none."""
    plain = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, PATTERNS["email"], " ")).otherwise(text)
    return F.filter(F.regexp_extract_all(F.lower(plain), F.lit(WORD), F.lit(0)), lambda w: w.rlike(TERM))


def _units(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){{1,{UNIT_WORDS}}}+"), F.lit(0))


def _protected(spans: str) -> Column:
    """Hashes of what the spans protect: each value and its class."""
    def of(x: Column) -> Column:
        value = F.lower(x["value"])
        digits = _digits(value)
        general = F.when(x["kind"] == "email", F.substring_index(value, "@", -1)).when(x["kind"] == "ip", F.substring_index(value, ".", 3)).when(x["kind"] == "phone", F.substring(digits, 1, 4)).otherwise(F.substring(digits, 1, 6))
        return F.array(F.xxhash64(x["kind"], F.lit("value"), value), F.xxhash64(x["kind"], F.lit("class"), general))

    return F.array_distinct(F.flatten(F.transform(spans, of)))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_t")).withColumn("_h", F.xxhash64("_id", "_t"))


def base_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, _h, _base`` for every row, written: texts are scanned once."""
    return materialize(with_spans(_rows(docs, id_col, text_col), "_t").select("_id", "_h", "_base"), "pii-base")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_IDS // 4 else df


def entity_units(docs: DataFrame, base: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``x, e, words``: units with an entity that occurs in enough rows, and
    their terms in order."""
    found = base.filter(F.size("_base") > 0).select("_h", F.explode(_protected("_base")).alias("e"))
    often = materialize(found.groupBy("e").agg(F.count("*").alias("c")).filter(F.col("c") >= LEAST_CONTEXTS).select("e"), "pii-often")
    wanted = materialize(found.join(_small(often), "e", "left_semi").select("_h").distinct(), "pii-wanted")
    # a text whose hash is wanted by chance has entities of its own, or none
    texts = may_hold(_rows(docs, id_col, text_col), wanted, "_h")
    units = texts.select("_h", F.posexplode(_units(F.col("_t"))).alias("k", "s")).select(F.xxhash64("_h", "k").alias("x"), "s")
    named = with_spans(units, "s").filter(F.size("_base") > 0).select("x", F.explode(_protected("_base")).alias("e"), _terms(F.col("s")).alias("words"))
    units = materialize(named.join(_small(often), "e", "left_semi"), "pii-units")
    discard(often, wanted)
    return units


def _value(n_te, n_t, n_e, total: int) -> Column:
    """Disclosure from counts of units."""
    n = F.lit(float(max(total, 2)))
    p = lambda c: F.least(F.col(c) / n, F.lit(1 - 1e-9))
    return F.log(p(n_te) / (p(n_t) * p(n_e))) / -F.log(p(n_e))


def hopeful_pairs(units: DataFrame, total: int, least: float) -> DataFrame:
    """``e, term, n_te, n_e`` of terms in enough units of an entity that may
    disclose it: the units with any entity bound a term's count from below."""
    counted = units.select("e", F.explode(F.array_distinct("words")).alias("term")).groupBy("e", "term").agg(F.count("*").alias("n_te")).filter(F.col("n_te") >= LEAST_CONTEXTS)
    counted = materialize(counted, "pii-counted")
    # one entity of each unit stands for it
    one = units.join(units.groupBy("x").agg(F.min("e").alias("e")), ["x", "e"])
    known = _small(materialize(counted.select("term").distinct(), "pii-known"))
    low = one.select(F.explode(F.array_distinct("words")).alias("term")).join(known, "term").groupBy("term").agg(F.count("*").alias("n_low"))
    n_e = units.groupBy("e").agg(F.count("*").alias("n_e"))
    return counted.join(n_e, "e").join(low, "term").filter(_value("n_te", "n_low", "n_e", total) >= least).drop("n_low")


def supported(units: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` that are seen in LEAST_CONTEXTS different surroundings.

    So many pairs of neighbours of the term must differ, and so many units: a
    unit counts 1 / m if half of its runs of three terms are in m or more units
    of the entity, so m near copies count as about one, and neither they nor a
    full vocabulary lessen what others count.
    """
    beside = F.transform("words", lambda w, k: F.struct(w.alias("term"), F.xxhash64(F.get("words", k - 1), F.get("words", k + 1)).alias("c")))
    spots = units.select("e", F.explode(F.array_distinct(beside)).alias("s")).select("e", "s.term", "s.c").join(_small(pairs.select("e", "term")), ["e", "term"], "left_semi").distinct()
    varied = spots.groupBy("e", "term").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_CONTEXTS)
    pairs = materialize(pairs.join(varied.select("e", "term"), ["e", "term"]), "pii-varied")
    some = units.join(_small(materialize(pairs.select("e").distinct(), "pii-seen")), "e", "left_semi")
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - 3, F.lit(0))), lambda k: F.xxhash64(F.get("words", k), F.get("words", k + 1), F.get("words", k + 2)))
    grams = materialize(some.select("e", "x", F.explode(F.array_distinct(runs)).alias("g")), "pii-grams")
    shared = grams.groupBy("e", "g").agg(F.count("*").alias("m"))
    often = grams.join(shared, ["e", "g"]).groupBy("e", "x").agg(F.sort_array(F.collect_list("m")).alias("m"))
    weights = often.select("e", "x", (1 / F.get("m", F.floor((F.size("m") - 1) / 2).cast("int"))).alias("weight"))
    terms = some.select("e", "x", F.explode(F.array_distinct("words")).alias("term")).join(_small(pairs.select("e", "term")), ["e", "term"], "left_semi")
    support = terms.join(weights, ["e", "x"]).groupBy("e", "term").agg(F.sum("weight").alias("support"))
    return pairs.join(support.filter(F.col("support") >= LEAST_CONTEXTS - 1e-9).select("e", "term"), ["e", "term"])


def _valued(pairs: DataFrame, texts: DataFrame, total: int, form) -> DataFrame:
    """``term, disclosure`` (the largest over entities) of pairs ``e, term,
    n_te, n_e``; ``form`` makes the terms that count out of a unit's words."""
    candidates = _small(materialize(pairs.select("term").distinct(), "pii-candidates"))
    every = texts.select(F.explode(_units(F.col("_t"))).alias("s"))
    n_t = every.select(F.explode(F.array_distinct(form(_terms(F.col("s"))))).alias("term")).join(candidates, "term").groupBy("term").agg(F.count("*").alias("n_t"))
    return pairs.join(n_t, "term").groupBy("term").agg(F.max(_value("n_te", "n_t", "n_e", total)).alias("disclosure"))


def _total(texts: DataFrame) -> int:
    """Units of all texts: whole words by UNIT_WORDS."""
    words = F.regexp_count("_t", F.lit(r"[^\x20\x09-\x0D]++"))
    return texts.agg(F.sum(F.ceil(words / UNIT_WORDS)).alias("n")).first()["n"] or 0


def disclosures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: DataFrame | None = None, least: float = DISCLOSURE) -> DataFrame:
    """``term, disclosure`` of the terms with enough support that reach ``least``."""
    return _disclosures(docs, id_col, text_col, base, least)[0]


def _disclosures(docs: DataFrame, id_col: str, text_col: str, base: DataFrame | None, least: float) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Also the pairs and units that the values come from, and all units."""
    base = base_table(docs, id_col, text_col) if base is None else base
    units, texts = entity_units(docs, base, id_col, text_col), _rows(docs, id_col, text_col)
    none = docs.sparkSession.createDataFrame([], "term string, disclosure double")
    if units.isEmpty():
        return none, units, units, 0
    total = _total(texts)
    pairs = materialize(hopeful_pairs(units, total, least), "pii-hopeful")
    pairs = materialize(supported(units, pairs), "pii-pairs") if not pairs.isEmpty() else pairs
    if pairs.isEmpty():
        return none, pairs, units, total
    return materialize(_valued(pairs, texts, total, lambda words: words).filter(F.col("disclosure") >= least), "pii-disclosures"), pairs, units, total


def revealing_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: DataFrame | None = None) -> DataFrame:
    """``term, disclosure, shown``: the terms to be sanitised, and the general
    form that takes a term's place ('' if that reveals too much as well)."""
    high, pairs, units, total = _disclosures(docs, id_col, text_col, base, DISCLOSURE)
    if high.isEmpty():
        return high.withColumn("shown", F.lit(""))
    stems = lambda words: F.transform(F.filter(words, lambda w: F.length(w) > STEM), lambda w: F.substring(w, 1, STEM))
    long = high.filter(F.length("term") > STEM).withColumn("stem", F.substring("term", 1, STEM))
    asked = pairs.join(long.select("term", "stem"), "term").select("e", F.col("stem").alias("term"), "n_e").distinct()
    seen = units.select("e", "x", F.explode(F.array_distinct(stems(F.col("words")))).alias("term"))
    counted = materialize(seen.join(asked, ["e", "term"]).groupBy("e", "term", "n_e").agg(F.count("*").alias("n_te")), "pii-stems")
    general = _valued(counted, _rows(docs, id_col, text_col), total, stems).select(F.col("term").alias("stem"), F.col("disclosure").alias("_general"))
    ladder = long.join(general, "stem", "left").filter(F.col("_general") < DISCLOSURE).select("term", F.concat("stem", F.lit("*")).alias("shown"))
    terms = materialize(high.join(ladder, "term", "left").select("term", "disclosure", F.coalesce("shown", F.lit("")).alias("shown")), "pii-terms")
    discard(pairs, units, counted)
    return terms


def with_all_spans(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds ``_base`` and ``_all`` (base and term spans, with ``shown``)."""
    based = with_spans(docs, text_col)
    shown_of = F.create_map(*(F.lit(x) for pair in PLACEHOLDERS.items() for x in pair))
    named = F.transform("_base", lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"), F.element_at(shown_of, x["kind"]).alias("shown")))
    if terms.isEmpty():
        return based.withColumn("_all", named)
    keyed = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("_row"), F.col(text_col).alias("_text"))
    words = keyed.select("_row", F.explode(F.array_distinct(_terms(F.col("_text")))).alias("term"))
    listed = words.join(_small(terms).select("term", "shown"), "term").groupBy("_row").agg(F.map_from_entries(F.collect_set(F.struct("term", "shown"))).alias("_terms"))
    listed = materialize(listed, "pii-listed")
    marked = based.withColumn("_row", F.xxhash64(F.col(id_col), F.col(text_col))).join(F.broadcast(listed) if listed.count() <= BROADCAST_IDS // 40 else listed, "_row", "left").drop("_row")
    # terms are letters only, so they need no escape; only they are located
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}_])(?:"), F.array_join(F.map_keys("_terms"), "|"), F.lit(r")(?![\p{L}\p{N}_])"))
    located = F.transform(_located(F.col(text_col), pattern), lambda x: F.struct(x["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), x["end"].alias("end"), F.lit("term").alias("kind"), F.coalesce(F.element_at("_terms", F.lower(x["value"])), F.lit("")).alias("shown")))
    return marked.withColumn("_all", F.when(F.col("_terms").isNotNull(), F.array_sort(F.concat(named, located))).otherwise(named)).drop("_terms")


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term``."""
    base = base_table(docs, id_col, text_col)
    terms = revealing_terms(docs, id_col, text_col, base)
    if terms.isEmpty():
        found = base.select(F.col("_id").cast("long").alias("doc_id"), "_base", F.col("_base").alias("_all"))
    else:
        rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_t"))
        found = with_all_spans(rows, terms, "_id", "_t").withColumn("doc_id", F.col("_id").cast("long"))
    count = lambda spans, kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count("_base", k).alias(f"n_{k}") for k in KINDS), F.sha2(_joined("_base"), 256).alias("base_sha256"), _joined("_all").alias("spans"), count("_all", "term").alias("n_term"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with spans of ``text_col`` generalised or removed.

    Of overlapping spans the first decides and covers the others.
    """
    terms = revealing_terms(docs, id_col, text_col)
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_t"))
    found = with_all_spans(rows, terms, "_id", "_t")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,to:int,shown:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        one = F.array(F.struct(acc["at"].alias("from"), x["start"].alias("to"), x["shown"].alias("shown")))
        inside = x["start"] < acc["at"]
        return F.struct(F.greatest(x["end"], acc["at"]).alias("at"), F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], one)).alias("out"))

    def rebuilt(folded: Column) -> Column:
        text = F.col("_t")
        pieces = F.transform(folded["out"], lambda p: F.concat(F.substring(text, p["from"] + 1, p["to"] - p["from"]), p["shown"]))
        return F.concat(F.array_join(pieces, ""), F.substring(text, folded["at"] + 1, F.length(text)))

    clean = let(F.aggregate("_all", zero, step), rebuilt)
    changed = F.when(F.size("_all") > 0, clean).otherwise(F.col("_doc")[text_col])
    return found.select(*((changed if c == text_col else F.col("_doc")[c]).alias(c) for c in docs.columns))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))


QUERIES = {"op4_pii": op4_pii}
