"""Quality by weak labels: heuristic labellers, EM, and a hashed linear scorer.

1. Overlapping heuristic labellers (symbols, capitals, repetition, word shapes,
   ...) vote good, bad or abstain on every document.
2. Expectation maximisation estimates their accuracies from the counted vote
   patterns of all documents (a table bounded by the labellers).
3. The posterior labels of a bounded sample train a linear scorer over hashed
   word shapes and statistics; it alone scores the documents.

Defined results: null or empty text, or text without a word, scores 0 and is
rejected; a score of exactly 0.5 is good; repeated rows repeat; very long texts
are described piece by piece, as a whole; an empty table gives an empty table;
other columns are kept by ``keep_good`` and ignored by ``score``. Human labels
are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import frugal, mix, small_batches, table, text_chunks, unit_hash, window_hash, word_pieces
from foliospark.llm.label_model import LabelModel, fit_label_model, fit_linear

#: About so many documents, chosen by a hash of the id, train the scorer.
TRAIN_ROWS = 10_000
#: Dimensions of the hashed feature space; a sampled document sends at most so
#: many features of six bytes to the driver.
DIMENSIONS = 1 << 12
#: Share of bad documents from which EM starts, and labellers that call 30 % of
#: the bad documents bad and 98 % of the good ones good.
START_BAD, START_VOTES = 0.15, (0.3, 0.98)
#: A labeller calls at most so many of the good documents that it votes on bad;
#: how many of the bad ones it finds is estimated freely.
MOST_FALSE = 0.01
THRESHOLD = 0.5

_CLASS = np.full(256, ord("a"), np.uint8)
_CLASS[:128] = np.arange(128)
_CLASS[65:91] = ord("A")
_CLASS[97:123] = ord("a")
_CLASS[48:58] = ord("0")
_CLASS[[9, 10, 11, 12, 13]] = 32
_LETTER = (_CLASS == ord("a")) | (_CLASS == ord("A"))
_ALNUM = _LETTER | (_CLASS == ord("0"))
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".,;:?"]] = True
_ODD = np.zeros(256, bool)
_ODD[[ord(c) for c in "#$%&*|!<>{}[]~^=_\\@+`"]] = True
#: Bytes that begin a letter, and those that begin one of the scripts from
#: U+0E00 on, most of which are written without spaces.
_LEAD = (np.arange(256) < 0x80) | (np.arange(256) >= 0xC0)
_LEAD &= _LETTER
_WIDE = (np.arange(256) == 0xE0) | (np.arange(256) >= 0xE3)
_MASKS = {"letter": _LETTER, "alnum": _ALNUM, "digit": _CLASS == ord("0"), "upper": _CLASS == ord("A"), "odd": _ODD, "chars": _LEAD, "wide": _WIDE}


@dataclass
class Stats:
    """Per-document numbers, and a hashed shape for every word."""

    rows: int
    n: np.ndarray
    values: dict[str, np.ndarray]
    doc: np.ndarray
    shapes: np.ndarray  # dimension of each word's shape


def _distinct(hashes: np.ndarray, doc: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row, and its most frequent one's count."""
    key, counts = np.unique((doc.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)), return_counts=True)
    owner = (key >> np.uint64(40)).astype(np.int64)
    most = np.zeros(rows, np.int64)
    np.maximum.at(most, owner, counts)
    return np.bincount(owner, minlength=rows), most


def _shapes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each word's shape, hashed: its bytes by class, equal neighbours joined."""
    classes = _CLASS[raw]
    fresh = np.ones(len(raw), bool)
    fresh[1:] = classes[1:] != classes[:-1]
    fresh[starts] = True
    fresh &= classes != 32
    at = np.flatnonzero(fresh)
    first = np.searchsorted(at, starts)
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    part = mix((classes[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) * (place + 1).astype(np.uint64)
    return (mix(np.add.reduceat(part, first)) % np.uint64(DIMENSIONS)).astype(np.uint16)


def describe(texts: pa.Array) -> Stats:
    """Statistics of every row. What is kept of a long text is a hash, a shape
    and a row number for each word."""
    rows = len(texts)
    n, total = np.zeros(rows, np.int64), {k: np.zeros(rows) for k in ("size", "chars", "wide", "letter", "upper", "odd", "plain", "bare", "stops")}
    hashes, shapes, docs = [], [], []
    for piece in word_pieces(texts):
        words = piece.words
        new = slice(piece.begin, piece.end)
        starts, ends = words.starts[new], words.ends[new]
        if not len(starts):
            continue
        doc, raw = words.doc[new] + piece.lo, words.raw
        size = (ends - starts).astype(np.int32)
        # a word's bytes up to the next word: white space counts for nothing
        last = ends[-1]
        per = {k: np.add.reduceat(mask[raw[:last]], starts, dtype=np.int32) for k, mask in _MASKS.items()}
        tail = raw[ends - 1]
        number = (per["digit"] > 0) & (2 * per["alnum"] >= size)
        plain = (per["letter"] == size) | ((per["letter"] == size - 1) & _END[tail]) | number
        for k, x in (per | {"size": size, "plain": plain, "bare": per["alnum"] == 0, "stops": _END[tail]}).items():
            if k in total:
                total[k] += np.bincount(doc, x, rows)
        n += np.bincount(doc, minlength=rows)
        hashes.append(words.word_hash()[new])
        shapes.append(_shapes(raw[starts[0] : last], starts - starts[0]))
        docs.append(doc.astype(np.int32))
    doc = np.concatenate(docs) if docs else np.empty(0, np.int32)
    h = np.concatenate(hashes) if docs else np.empty(0, np.uint64)
    del hashes, docs
    count = np.maximum(n, 1)
    distinct, most = _distinct(h, doc, rows)
    stutter = np.bincount(doc[1:], (h[1:] == h[:-1]) & (doc[1:] == doc[:-1]), rows) if len(doc) else np.zeros(rows)
    runs = window_hash(h, 3)
    same = doc[: len(runs)] == doc[2:] if len(doc) > 2 else np.empty(0, bool)
    own, runs = doc[: len(runs)][same], runs[same]
    n_runs = np.bincount(own, minlength=rows)
    new_runs, _ = _distinct(runs, own, rows)
    values = {
        "odd": total["odd"] / np.maximum(total["size"], 1),
        "upper": total["upper"] / np.maximum(total["letter"], 1),
        "variety": distinct / np.sqrt(count),
        "top": most / count,
        "plain": total["plain"] / count,
        "bare": total["bare"] / count,
        "repeat": 1 - new_runs / np.maximum(n_runs, 1) * (n_runs > 0) - (n_runs == 0),
        # a script without spaces has no words to be long
        "length": np.where(2 * total["wide"] > total["chars"], 5.0, total["chars"] / count),
        "stutter": stutter / count,
        "stops": total["stops"] / count,
    }
    return Stats(rows, n, values, doc, np.concatenate(shapes) if shapes else np.empty(0, np.uint16))


#: Labellers: statistic, bad beyond, good within, direction (1: high is bad),
#: and the fewest words from which they vote.
LABELLERS = (
    ("odd", 0.06, 0.02, 1, 3),
    ("upper", 0.45, 0.2, 1, 3),
    ("variety", 1.5, 3.5, -1, 30),
    ("top", 0.35, 0.15, 1, 10),
    ("plain", 0.6, 0.85, -1, 5),
    ("bare", 0.15, 0.03, 1, 5),
    ("repeat", 0.5, 0.15, 1, 15),
    ("length", 12.0, 8.0, 1, 5),
    ("stutter", 0.25, 0.05, 1, 10),
)


def votes_of(stats: Stats) -> np.ndarray:
    """Votes of each document: 0 abstain, 1 bad, 2 good."""
    out = []
    for name, bad, good, sign, least in LABELLERS:
        x = stats.values[name] * sign
        vote = np.where(x >= bad * sign, 1, np.where(x <= good * sign, 2, 0))
        out.append(np.where(stats.n >= least, vote, 0))
    return np.stack(out, axis=1).astype(np.int64)


_BINS = np.array([0.0, 0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9, 1.5, 2.5, 4.0, 7.0, 12.0])


def features(stats: Stats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, dimension, value): shape shares, and one bin of each statistic."""
    rows, cols, values = [], [], []
    most = np.uint64(DIMENSIONS)
    key, counts = np.unique((stats.doc.astype(np.uint64) << np.uint64(32)) | stats.shapes, return_counts=True)
    owner = (key >> np.uint64(32)).astype(np.int64)
    rows.append(owner)
    cols.append((key & np.uint64(0xFFFFFFFF)).astype(np.int64))
    values.append(np.sqrt(counts / stats.n[owner]))
    some = np.flatnonzero(stats.n > 0)
    for k, x in enumerate(stats.values.values()):
        b = np.searchsorted(_BINS, x[some], "right").astype(np.uint64)
        short = (stats.n[some] < 20).astype(np.uint64)
        rows.append(some)
        cols.append((mix(b + np.uint64(64 * k + 1) + short * np.uint64(4096)) % most).astype(np.int64))
        values.append(np.full(len(some), 0.5))
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(values)


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    label_model: LabelModel

    def scores(self, texts: pa.Array) -> np.ndarray:
        stats = describe(texts)
        row, col, value = features(stats)
        z = self.bias + np.bincount(row, value * self.weights[col], stats.rows)
        return np.where(stats.n > 0, 1 / (1 + np.exp(-np.clip(z, -50, 50))), 0.0)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> QualityModel:
    """Vote patterns over all documents; features of the sampled ones."""
    small_batches(docs.sparkSession)
    total = docs.count()
    fraction = min(1.0, train_rows / max(total, 1))
    rows = docs.select(F.col(text_col).cast("string").alias("t"), (unit_hash(F.col(id_col), seed=13) < fraction).alias("s"))

    def vote(batches):
        seen: dict[tuple, int] = {}
        for batch in batches:
            inside = np.asarray(batch.column(1)).astype(bool) if batch.num_rows else np.empty(0, bool)
            for lo, hi in text_chunks(batch.column(0)):
                stats = describe(batch.column(0).slice(lo, hi - lo))
                votes = votes_of(stats)
                keys, counts = np.unique(votes[stats.n > 0], axis=0, return_counts=True)
                for key, c in zip(keys.tolist(), counts.tolist(), strict=True):
                    seen[tuple(key)] = seen.get(tuple(key), 0) + c
                pick = np.flatnonzero(inside[lo:hi] & (stats.n > 0))
                if not len(pick):
                    continue
                row, col, value = features(stats)
                order = np.argsort(row, kind="stable")
                row, col, value = row[order], col[order], value[order]
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays([pa.array(votes[pick].tolist(), pa.list_(pa.int64())), pa.array([col[cut[k] : cut[k + 1]].astype(np.int16) for k in pick], pa.list_(pa.int16())), pa.array([value[cut[k] : cut[k + 1]].astype(np.float32) for k in pick], pa.list_(pa.float32())), pa.array(np.ones(len(pick), np.int64))], ["votes", "cols", "vals", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([list(k) for k in seen], pa.list_(pa.int64())), pa.nulls(len(seen), pa.list_(pa.int16())), pa.nulls(len(seen), pa.list_(pa.float32())), pa.array(list(seen.values()), pa.int64())], ["votes", "cols", "vals", "n"])

    found = rows.mapInArrow(frugal(vote), "votes array<long>, cols array<short>, vals array<float>, n long").toArrow()
    votes = np.array(found["votes"].to_pylist(), np.int64).reshape(-1, len(LABELLERS))
    sampled = np.asarray(found["cols"].is_valid())
    model = fit_label_model(votes[~sampled], np.asarray(found["n"]).astype(float)[~sampled], 1 - START_BAD, start=START_VOTES, most_false=MOST_FALSE)
    part = found.filter(found["cols"].is_valid())
    target = model.posterior(votes[sampled])
    cols, values = part["cols"].combine_chunks(), part["vals"].combine_chunks()
    lengths = np.asarray(pa.compute.list_value_length(cols)).astype(np.int64) if len(target) else np.empty(0, np.int64)
    r = np.repeat(np.arange(len(target)), lengths)
    w, bias = fit_linear(r, np.asarray(cols.flatten()).astype(np.int64), np.asarray(values.flatten()).astype(float), target, DIMENSIONS)
    return QualityModel(w, bias, model)


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, good`` for every row; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for lo, hi in text_chunks(batch.column(1)):
                s = shared.value.scores(batch.column(1).slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(s), pa.array(s >= THRESHOLD)], ["doc_id", "score", "good"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(frugal(run), "doc_id long, score double, good boolean")


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows that the scorer accepts, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for lo, hi in text_chunks(batch.column(at)):
                part = batch.slice(lo, hi - lo)
                yield part.filter(pa.array(shared.value.scores(part.column(at)) >= THRESHOLD))

    return docs.mapInArrow(frugal(run), docs.schema)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs))


QUERIES = {"op9_quality_classifier": op9_quality_classifier}
