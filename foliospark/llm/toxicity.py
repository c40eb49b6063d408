"""Toxicity by weak supervision.

1. Lexicons of words and word beginnings are induced from the labelled
   training rows: terms far more frequent in toxic documents than in clean.
2. Voters (lexicons by kind and strength, a fixed insult list, shouting and
   exclamation patterns) vote on documents. A generative label model estimates
   their accuracies and correlations from the counted vote patterns.
3. A linear classifier over hashed term features is trained on the posterior
   labels of a bounded sample; it alone scores the documents.

Defined results: null or empty text has no term and gets the score of the
intercept; a score of exactly 0.5 is toxic; a very long text is read in pieces,
as a whole; a document with several labels is toxic if one says so; an empty
table gives an empty table; repeated rows repeat; other columns are ignored.
Without labelled rows the fixed insult list remains.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import WordBatch, bucket, frugal, mix, small_batches, table, text_chunks, unit_hash, word_pieces
from foliospark.llm.label_model import LabelModel, fit_label_model, fit_linear

#: Bounds of the training (parameters of ``fit``): about so many labelled toxic
#: rows propose terms, and so many rows train the linear classifier.
TOXIC_ROWS, LINEAR_ROWS = 10_000, 20_000
#: A term must be in so many toxic rows (or this share of them), and so many
#: times as frequent in toxic as in clean rows.
LEAST_ROWS, LEAST_SHARE, LEAST_LIFT, STRONG_LIFT = 3, 0.001, 12.0, 50.0
#: And so many standard deviations more often than clean rows make likely.
LEAST_Z = 10.0
#: And between so many different pairs of words, as a share of its toxic rows; so
#: many pairs are enough however many rows hold it.
LEAST_CONTEXTS, ENOUGH_CONTEXTS = 0.25, 25
#: Voters from which EM starts: quiet on 95 % of the clean rows, loud on half of
#: the toxic ones.
START_VOTES = (0.95, 0.5)
#: Plain English insults.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown", "imbecile", "dumb", "retard", "vermin", "filth", "bastard", "bitch", "asshole")
#: Features: the whole word, and its first so many bytes (a shorter word whole).
PREFIXES = (4, 5, 6, 8)
_PUNCT = np.zeros(256, bool)
_PUNCT[[ord(c) for c in ".,;:!?\"'()[]{}<>*_~`"]] = True


def trimmed(batch: WordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Word bounds without punctuation at either end (a word keeps a byte)."""
    starts, ends, data = batch.starts.copy(), batch.ends.copy(), batch.data
    for _ in range(4):
        ends -= (ends - starts > 1) & _PUNCT[data[np.maximum(ends - 1, 0)]]
        starts += (ends - starts > 1) & _PUNCT[data[np.minimum(starts, len(data) - 1)]]
    return starts, ends


def term_hashes(batch: WordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row of the batch, hash) arrays: whole words, then each prefix length."""
    if not len(batch.starts):
        return [(np.empty(0, np.int64), np.empty(0, np.uint64))] * (1 + len(PREFIXES))
    starts, ends = trimmed(batch)
    doc = batch.doc
    out = [(doc, batch.span_hash(starts, ends))]
    for k, size in enumerate(PREFIXES, 1):
        out.append((doc, batch.span_hash(starts, np.minimum(ends, starts + size)) + np.uint64(k * 0x51_7C_C1_B7)))
    return out


def hash_words(words: tuple[str, ...]) -> np.ndarray:
    return WordBatch(pa.array(list(words))).word_hash()


@dataclass
class Terms:
    """Known terms: sorted hashes with kind (0 word, 1.. prefix) and lift."""

    hashes: np.ndarray
    kinds: np.ndarray
    lifts: np.ndarray

    def hits(self, words: WordBatch, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, term index) of words from ``begin`` to ``end``; pairs repeat."""
        rows, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for row, h in term_hashes(words) if len(self.hashes) else ():
            row, h = row[begin:end], h[begin:end]
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            ok = self.hashes[at] == h
            rows.append(row[ok])
            found.append(at[ok])
        return np.concatenate(rows), np.concatenate(found)


class Reading:
    """What is found in the rows of an Arrow array of texts: distinct (row, term)
    pairs, and with ``votes`` what the other voters look at."""

    def __init__(self, texts: pa.Array, terms: Terms, votes: bool = False):
        self.rows, most = len(texts), np.int64(max(len(terms.hashes), 1))
        self.n_words, self.listed, self.upper, self.marks, self.size = (np.zeros(self.rows, np.int64) for _ in range(5))
        keys, insults = [np.empty(0, np.int64)], hash_words(INSULTS)
        for piece in word_pieces(texts):
            words, new = piece.words, slice(piece.begin, piece.end)
            row, term = terms.hits(words, piece.begin, piece.end)
            keys.append(np.unique((row + piece.lo) * most + term))
            if not votes:
                continue
            here, doc = slice(piece.lo, piece.hi), words.doc
            first = np.clip(words.first, piece.begin, piece.end)
            self.n_words[here] += np.diff(first)
            self.listed[here] += np.bincount(doc[new], np.isin(term_hashes(words)[0][1][new], insults), words.rows).astype(np.int64)
            lo = np.append(words.starts, len(words.data))[first[:-1]]
            hi = np.maximum(np.append(0, words.ends)[first[1:]], lo)
            some = np.diff(first) > 0
            self.size[here] += np.where(some, hi - lo, 0)
            for total, is_one in ((self.upper, (words.raw >= 65) & (words.raw <= 90)), (self.marks, words.raw == 33)):
                counted = np.concatenate([[0], np.cumsum(is_one)])
                total[here] += np.where(some, counted[hi] - counted[lo], 0)
        key = np.unique(np.concatenate(keys))
        self.row, self.term = key // most, key % most


@dataclass
class ToxicityModel:
    terms: Terms
    weights: np.ndarray
    bias: float
    label_model: LabelModel

    def scores(self, texts: pa.Array) -> np.ndarray:
        found = Reading(texts, self.terms)
        z = self.bias + np.bincount(found.row, self.weights[found.term], found.rows)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def votes_of(found: Reading, terms: Terms) -> np.ndarray:
    """A row of votes (0 abstain, 1 clean, 2 toxic) for each text."""
    voters = []
    quiet = np.where(found.n_words > 0, 1, 0)
    for kind in range(1 + len(PREFIXES)):
        for strong in (False, True):
            of = (terms.kinds == kind) & ((terms.lifts >= STRONG_LIFT) == strong)
            hit = np.bincount(found.row, of[found.term], found.rows) > 0
            voters.append(np.where(hit, 2, quiet))
    voters.append(np.where(found.listed > 0, 2, quiet))
    for counted, loud, calm in ((found.upper, 0.5, 0.3), (found.marks, 0.05, 0.01)):
        share = counted / np.maximum(found.size, 1)
        voters.append(np.where(found.n_words < 5, 0, np.where(share > loud, 2, np.where(share < calm, 1, 0))))
    return np.stack(voters, axis=1).astype(np.int64)


def induce_terms(labelled: DataFrame, toxic_rows: int = TOXIC_ROWS) -> tuple[Terms, float]:
    """Terms from rows (i, t, y); and the share of toxic rows.

    About ``toxic_rows`` toxic rows propose every term that enough of them hold
    (fewer terms than these rows have words); all proposals are then counted
    over all labelled rows.
    """
    totals = {r["y"]: r["n"] for r in labelled.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    none = Terms(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0))
    if not n1:
        return none, 0.05
    fraction = min(1.0, toxic_rows / n1)
    toxic = labelled.filter((F.col("y") == 1) & (unit_hash(F.col("i"), seed=7) < fraction))
    least = max(LEAST_ROWS, int(LEAST_SHARE * n1 * fraction))

    def propose(batches):
        for batch in batches:
            for piece in word_pieces(batch.column(0), 1):
                hashes, new = term_hashes(piece.words), slice(piece.begin, piece.end)
                doc, own = hashes[0]
                before, after = np.zeros(len(own), np.uint64), np.zeros(len(own), np.uint64)
                before[1:] = np.where(doc[1:] == doc[:-1], own[:-1], 0)
                after[:-1] = np.where(doc[1:] == doc[:-1], own[1:], 0)
                beside = mix(before + after * np.uint64(0x9E3779B97F4A7C15))[new]
                for kind, (_, h) in enumerate(hashes):
                    h = h[new]
                    order = np.lexsort((beside, h))
                    h, p = h[order], beside[order]
                    fresh = np.ones(len(h), bool)
                    fresh[1:] = (h[1:] != h[:-1]) | (p[1:] != p[:-1])
                    yield pa.RecordBatch.from_arrays([pa.array(h[fresh].view(np.int64)), pa.array(np.full(fresh.sum(), kind, np.int32)), pa.array(p[fresh].view(np.int64))], ["h", "kind", "p"])

    # a term's support is the number of different pairs of words beside it: copies
    # of a passage are no evidence
    proposed = toxic.select("t").mapInArrow(frugal(propose), "h long, kind int, p long").distinct().groupBy("h", "kind").agg(F.count("*").alias("n")).filter(F.col("n") >= least).toPandas()
    if proposed.empty:
        return none, n1 / (n1 + n0)
    order = np.argsort(proposed["h"].to_numpy().view(np.uint64))
    candidates = Terms(proposed["h"].to_numpy().view(np.uint64)[order], proposed["kind"].to_numpy()[order].astype(np.int64), np.zeros(len(order)))
    contexts = proposed["n"].to_numpy()[order]
    shared = labelled.sparkSession.sparkContext.broadcast(candidates)

    def count(batches):
        known = shared.value
        total = np.zeros((2, len(known.hashes)), np.int64)
        for batch in batches:
            y = np.asarray(batch.column(1)).astype(np.int64)
            found = Reading(batch.column(0), known)
            np.add.at(total, (y[found.row], found.term), 1)
        keep = np.flatnonzero(total.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(keep), pa.array(total[0, keep]), pa.array(total[1, keep])], ["k", "n0", "n1"])

    counted = labelled.select("t", "y").mapInArrow(frugal(count), "k long, n0 long, n1 long").groupBy("k").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    lift = np.zeros(len(order))
    c0, c1 = counted["n0"].to_numpy(), counted["n1"].to_numpy()
    lift[counted["k"].to_numpy()] = (c1 / n1) / ((c0 + 0.5) / (n0 + 1))
    support = np.zeros(len(order))
    support[counted["k"].to_numpy()] = c1
    expected = np.zeros(len(order))
    expected[counted["k"].to_numpy()] = (c0 + 0.5) * n1 / (n0 + 1)
    keep = np.flatnonzero((lift >= LEAST_LIFT) & (support >= LEAST_ROWS) & (contexts >= np.minimum(LEAST_CONTEXTS * support * fraction, ENOUGH_CONTEXTS)) & (support - expected >= LEAST_Z * np.sqrt(expected + 0.5)))
    return Terms(candidates.hashes[keep], candidates.kinds[keep], lift[keep]), n1 / (n1 + n0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", toxic_rows: int = TOXIC_ROWS, linear_rows: int = LINEAR_ROWS) -> ToxicityModel:
    """Learn from the rows of ``labels`` joined with ``docs``; ``docs`` without
    a label still vote. The caller holds rows out of both."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    marks = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("i")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    n = marks.count()
    labelled = rows.join(F.broadcast(marks) if n <= 1_000_000 else marks, "i").select("i", "t", F.when(F.col("y") > 0, 1).otherwise(0).alias("y"))
    terms, share = induce_terms(labelled, toxic_rows)
    extra = np.setdiff1d(hash_words(INSULTS), terms.hashes)
    order = np.argsort(np.concatenate([terms.hashes, extra]), kind="stable")
    terms = Terms(np.concatenate([terms.hashes, extra])[order], np.concatenate([terms.kinds, np.zeros(len(extra), np.int64)])[order], np.concatenate([terms.lifts, np.full(len(extra), LEAST_LIFT)])[order])
    total = rows.count()
    fraction = min(1.0, linear_rows / max(total, 1))
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def vote(batches):
        seen: dict[tuple, list] = {}
        for batch in batches:
            inside = np.asarray(batch.column(1)).astype(bool) if batch.num_rows else np.empty(0, bool)
            for lo, hi in text_chunks(batch.column(0)):
                found = Reading(batch.column(0).slice(lo, hi - lo), shared.value, votes=True)
                votes, row, term = votes_of(found, shared.value), found.row, found.term
                keys, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
                for key, c in zip(keys.tolist(), counts.tolist(), strict=True):
                    seen.setdefault(tuple(key), [0])[0] += c
                pick = np.flatnonzero(inside[lo:hi])
                cut = np.searchsorted(row, np.arange(found.rows + 1))
                yield pa.RecordBatch.from_arrays([pa.array(keys[which.ravel()[pick]].tolist(), pa.list_(pa.int64())), pa.array([term[cut[k] : cut[k + 1]].tolist() for k in pick], pa.list_(pa.int64())), pa.array(np.full(len(pick), -1, np.int64))], ["votes", "terms", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([list(k) for k in seen], pa.list_(pa.int64())), pa.array([None] * len(seen), pa.list_(pa.int64())), pa.array([v[0] for v in seen.values()], pa.int64())], ["votes", "terms", "n"])

    voted = rows.select("t", (unit_hash(F.col("i"), seed=11) < fraction).alias("s")).mapInArrow(frugal(vote), "votes array<long>, terms array<long>, n long").groupBy("votes", "terms").agg(F.sum("n").alias("n")).toPandas()
    patterns = voted[voted["terms"].isna()]
    width = 2 * (1 + len(PREFIXES)) + 3
    votes = np.array(patterns["votes"].tolist(), np.int64).reshape(-1, width)
    model = fit_label_model(votes, patterns["n"].to_numpy(np.float64), share, correlated=True, start=START_VOTES, fixed_prior=True)
    sample = voted[voted["terms"].notna()]
    weight = -sample["n"].to_numpy(np.int64)
    target = model.posterior(np.array(sample["votes"].tolist(), np.int64).reshape(-1, width))
    lists = [np.asarray(x, np.int64) for x in sample["terms"]]
    copies = np.repeat(np.arange(len(lists)), weight)  # equal rows come counted
    rows_, cols_ = [], []
    for k, i in enumerate(copies.tolist()):
        rows_.append(np.full(len(lists[i]), k))
        cols_.append(lists[i])
    r = np.concatenate(rows_).astype(np.int64) if rows_ else np.empty(0, np.int64)
    c = np.concatenate(cols_).astype(np.int64) if cols_ else np.empty(0, np.int64)
    w, bias = fit_linear(r, c, np.ones(len(r)), target[copies], len(terms.hashes), rounds=1500)
    return ToxicityModel(terms, w, bias, model)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted``; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for lo, hi in text_chunks(batch.column(2)):
                s = shared.value.scores(batch.column(2).slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (bucket(F.col(id_col), 5) == 0).alias("held_out"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    return rows.mapInArrow(frugal(run), "doc_id long, held_out boolean, score double, predicted int")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = bucket(F.col("doc_id"), 5) != 0
    return score(docs, fit(docs.filter(learn), table(spark, sf_dir, "labels").filter(learn)))


QUERIES = {"op7_toxicity": op7_toxicity}
