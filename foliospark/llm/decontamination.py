"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, units after a number and capitalised
words inside a sentence turn into typed placeholders, all else is lower-cased
and stripped of outer punctuation; windows with a capitalised word also count with
that word itself, and windows of little but numbers and units count as they are. Windows of five template tokens of documents
and benchmark items are hash-joined. A pair counts as a leak if windows with at
least half of the item's windows are in the document and the
slots agree: equal fillers (``verbatim``), or one consistent substitution
(``reparameterised``). Slots are compared in every place of the document that
may hold the item (hits of about equal document minus item offset) and over the
whole document; one place that agrees is enough. Where fillers contradict each
other everywhere, the windows with equal fillers count (``partial``).

Defined results: null or empty texts, of documents or items, match nothing; an
item of fewer than five words is one window of its own length, if it has at
least three words (fewer are no passage and match nothing); rows of one id count as one
document, rows without an id as one for each text; very long texts are read in
pieces whose windows overlap; equally good places of a document give the stronger
kind; an empty table gives an empty table; other columns are ignored by
``find_leaks`` and kept by ``drop_leaks``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import WordBatch, frugal, materialize, mix, small_batches, table, unused, window_hash, without, word_pieces
from foliospark.llm.toxicity import trimmed

WINDOW, LEAST_WORDS = 5, 3
#: Share of an item's windows that a document must hold.
COVERAGE = 0.5
#: A template needs so many words that are no placeholder (shorter ones: all but one).
LEAST_LITERALS = 3
#: Benchmark windows go to every task (8 bytes each) up to this count; beyond
#: it, all document windows are shuffled and joined instead.
BROADCAST_WINDOWS = 2_000_000
#: Words that a place may have more or less than the item, in two sizes.
SLACKS = (8, 64)
#: Units that follow a number.
UNITS = ("%", "percent", "kg", "g", "mg", "lb", "lbs", "oz", "ton", "tons", "km", "m", "cm", "mm", "mi", "mile", "miles", "ft", "feet", "foot", "inch", "inches", "yd", "yards", "meter", "meters", "metre", "metres", "kilometers", "kilometres", "l", "ml", "litre", "litres", "liter", "liters", "gallon", "gallons", "s", "sec", "seconds", "second", "min", "minute", "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "mph", "kph", "km/h", "m/s", "usd", "eur", "dollar", "dollars", "euro", "euros", "cent", "cents", "pound", "pounds", "degrees", "kwh", "kw", "w", "v", "hz", "gb", "mb", "kb", "tb")
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_NUMERIC = _DIGIT.copy()
_NUMERIC[[ord(c) for c in ".,:/%$+-"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;"]] = True
TEMPLATE, WORDED, EXACT = 0, 1, 2
NUMBER, UNIT, NAME = (np.uint64(x) for x in (0x6E756D, 0x756E69, 0x6E616D))


class Templates:
    """Template tokens of a batch: ``hash`` and ``kind`` (0 literal, 1 number,
    2 unit, 3 name) of every word."""

    def __init__(self, words: WordBatch):
        self.words = words
        self.kind = np.zeros(len(words.starts), np.int64)
        if not len(words.starts):
            self.hash = self.plain = self.exact = np.empty(0, np.uint64)
            self.starts, self.ends = words.starts, words.ends
            return
        data, raw = words.data, words.raw
        self.starts, self.ends = starts, ends = trimmed(words)
        self.hash = self.exact = words.span_hash(starts, ends)
        digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
        numeric = np.concatenate([[0], np.cumsum(_NUMERIC[data])])
        n_digits = digits[ends] - digits[starts]
        number = ((n_digits > 0) & (numeric[ends] - numeric[starts] == ends - starts)) | ((n_digits > 0) & _DIGIT[data[starts]])
        first = np.zeros(len(starts), bool)
        first[words.first[:-1][words.first[:-1] < len(starts)]] = True
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        opens = first.copy()
        opens[1:] |= _STOP[data[words.ends[:-1] - 1]] | (breaks[starts[1:]] > breaks[words.ends[:-1]])
        name = (raw[starts] >= 65) & (raw[starts] <= 90) & ~opens & ~number
        after = np.zeros(len(starts), bool)
        after[1:] = number[:-1] & ~first[1:]
        listed = after & np.isin(self.hash, _unit_hashes())
        self.kind[number], self.kind[name], self.kind[listed] = 1, 3, 2
        self.plain = np.where(number, NUMBER, np.where(listed, UNIT, self.hash))
        self.hash = np.where(name, NAME, self.plain)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, hash and form of every window inside one text. Each word
        begins a window in one form at least:

        * TEMPLATE: numbers, units and names are placeholders;
        * WORDED, if there are names: those stand as words, so that capitals
          alone hide nothing;
        * EXACT, if too few words remain for these: all words as they are.
        """
        doc, n = self.words.doc, len(self.hash) - width + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int32)
        least, inside = min(LEAST_LITERALS, max(1, width - 1)), doc[:n] == doc[width - 1 :]
        literals, named = self._held(self.kind == 0, width), self._held(self.kind == 3, width)
        parts = []
        for form, of, use in ((TEMPLATE, self.hash, literals >= least), (WORDED, self.plain, (named > 0) & (literals + named >= least)), (EXACT, self.exact, literals + named < least)):
            at = np.flatnonzero(inside & use)
            parts.append((at, mix(window_hash(of, width)[at] + np.uint64(width + (4096 if form == EXACT else 0))), np.full(len(at), form, np.int32)))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    @staticmethod
    def _held(mask: np.ndarray, width: int) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[width:] - total[:-width]

    def slots(self, at: int, width: int, form: int) -> list[str]:
        """``offset:kind:filler`` of the placeholders in a window."""
        data = self.words.data
        shown = {TEMPLATE: (1, 2, 3), WORDED: (1, 2), EXACT: ()}[form]
        return [f"{k}:{self.kind[at + k]}:{data[self.starts[at + k] : self.ends[at + k]].tobytes().decode('utf8', 'replace')}" for k in range(width) if self.kind[at + k] in shown]

    def all_slots(self, at: np.ndarray, width: int, form: np.ndarray) -> pa.Array:
        return pa.array([self.slots(x, width, y) for x, y in zip(at.tolist(), form.tolist(), strict=True)], pa.list_(pa.string()))


def _unit_hashes() -> np.ndarray:
    return WordBatch(pa.array(list(UNITS))).word_hash()


def item_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, item_pos, w, width, item_slots`` for every benchmark window."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                pieces = [(Templates(p.words), p) for p in word_pieces(batch.column(1).slice(k, 1), WINDOW - 1)]
                width = min(WINDOW, sum(p.end - p.begin for _, p in pieces))
                if width < LEAST_WORDS:
                    continue
                for t, p in pieces:
                    at, h, form = t.windows(width)
                    new = (at >= p.begin) & (at < p.end)
                    at, h, form = at[new], h[new], form[new]
                    yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[k].as_py()] * len(at), pa.int64()), pa.array((at - p.begin + p.before).astype(np.int64)), pa.array(h.view(np.int64)), pa.array([width] * len(at), pa.int32()), t.all_slots(at, width, form)], ["item_id", "item_pos", "w", "width", "item_slots"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("t")).filter("item_id is not null and t is not null")
    return rows.mapInArrow(frugal(run), "item_id long, item_pos long, w long, width int, item_slots array<string>")


def _own_key(id_col: str, text_col: str) -> Column:
    """0 for rows with an id; rows without one are told apart by their text."""
    return F.when(F.col(id_col).isNull(), F.xxhash64(F.col(text_col).cast("string"))).otherwise(F.lit(0).cast("long"))


def document_windows(docs: DataFrame, widths: list[int], known: np.ndarray | None, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, own, row, pos, w, doc_slots``; only windows in ``known`` if that is given."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for batch in batches:
            for p in word_pieces(batch.column(3), max(widths) - 1):
                t, hashes = Templates(p.words), shared.value
                doc = t.words.doc
                for width in widths:
                    at, h, form = t.windows(width)
                    new = (at >= p.begin) & (at < p.end)
                    if hashes is not None:
                        new &= hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h
                    at, h, form = at[new], h[new], form[new]
                    of = pa.array(doc[at] + p.lo)
                    place = at - t.words.first[doc[at]] - p.begin + p.before
                    yield pa.RecordBatch.from_arrays([*(batch.column(k).take(of) for k in range(3)), pa.array(place), pa.array(h.view(np.int64)), t.all_slots(at, width, form)], ["doc_id", "own", "row", "pos", "w", "doc_slots"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _own_key(id_col, text_col).alias("own"), F.xxhash64(F.col(text_col).cast("string")).alias("row"), F.col(text_col).cast("string").alias("t")).filter("t is not null")
    return rows.mapInArrow(frugal(run), "doc_id long, own long, row long, pos long, w long, doc_slots array<string>")


def _leaks(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str) -> DataFrame:
    """``find_leaks`` with the column ``own`` (see ``_own_key``)."""
    small_batches(docs.sparkSession)
    windows = materialize(item_windows(items, item_col, item_text_col), "item-windows")
    distinct = windows.select("w", "width").distinct()
    small = distinct.count() <= BROADCAST_WINDOWS
    if small:
        found = distinct.toPandas()
        widths, known = sorted(found["width"].unique().tolist()), np.sort(found["w"].to_numpy(np.int64).view(np.uint64))
    else:
        widths, known = sorted(r["width"] for r in distinct.select("width").distinct().collect()), None
    if not widths:
        widths, known = [WINDOW], np.array([0], np.uint64)
    hits = document_windows(docs, widths, known, id_col, text_col)
    pairs = hits.join(F.broadcast(windows) if small and windows.count() <= BROADCAST_WINDOWS // 4 else windows, "w")
    fills = F.arrays_zip(F.col("item_slots").alias("a"), F.col("doc_slots").alias("b"))
    tail = lambda s: F.regexp_replace(s, r"^\d+:", "")
    pairs = pairs.select("doc_id", "own", "item_id", "row", F.col("item_pos").alias("at"), (F.col("pos") - F.col("item_pos")).alias("shift"), F.transform(fills, lambda x: F.struct(tail(x["a"]).alias("a"), tail(x["b"]).alias("b"))).alias("fills"))
    totals = windows.groupBy("item_id").agg(F.count_distinct("item_pos").alias("total"))
    # the whole document, every exact place, and places with a few words more or
    # less (ranges that overlap, so that no place is cut by all of them)
    whole = F.struct(F.lit(0).alias("by"), F.lit(0).cast("long").alias("row"), F.lit(0).cast("long").alias("part"))
    part = lambda by, x: F.struct(F.lit(by).alias("by"), F.col("row").alias("row"), x.cast("long").alias("part"))
    ranges = [part(2 * w + half, F.floor((F.col("shift") + half * (w // 2)) / w)) for w in SLACKS for half in (0, 1)]
    placed = pairs.withColumn("place", F.explode(F.array(whole, part(1, F.col("shift")), *ranges)))
    same = F.forall("fills", lambda x: x["a"] == x["b"])
    grouped = placed.groupBy("doc_id", "own", "item_id", "place").agg(F.collect_set("at").alias("ws"), F.collect_set(F.when(same, F.col("at"))).alias("same_ws"), F.array_distinct(F.flatten(F.collect_set("fills"))).alias("fills"))
    consistent = F.size("fills") == F.size(F.array_distinct("fills.a"))  # each filler of the item has one counterpart
    counted = F.when(consistent, F.size("ws")).otherwise(F.size("same_ws")).cast("long")
    kind = F.when(same, "verbatim").when(consistent, "reparameterised").otherwise("partial")
    best = grouped.groupBy("doc_id", "own", "item_id").agg(F.max(F.struct(counted.alias("n"), kind.alias("kind"))).alias("x"))  # kinds ascend in strength
    scored = best.join(totals, "item_id").select("doc_id", "own", "item_id", F.col("x.n").alias("n_windows"), (F.col("x.n") / F.col("total")).alias("coverage"), "x.kind")
    return scored.filter(F.col("coverage") >= COVERAGE)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, n_windows, coverage, kind`` for every leak.

    Document windows are filtered before they leave the scan, so what is
    shuffled is hits; hits are summed up per document and item with a
    map-side combine.
    """
    return _leaks(docs, items, id_col, text_col, item_col, item_text_col).drop("own")


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without a leak, with all their columns."""
    # an id, or what tells rows without one apart, as one key
    named = lambda doc_id, own: F.coalesce(doc_id.cast("string"), F.concat(F.lit("h"), own.cast("string")))
    (key,) = unused(docs, "_key")
    bad = materialize(_leaks(docs, items, id_col, text_col, "item_id", "text").select(named(F.col("doc_id"), F.col("own")).alias(key)).distinct(), "leaks")
    keyed = docs.withColumn(key, named(F.col(id_col).cast("long"), _own_key(id_col, text_col)))
    return without(keyed, bad, key).select(*docs.columns)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op5_benchmark_decontamination": op5_benchmark_decontamination}
