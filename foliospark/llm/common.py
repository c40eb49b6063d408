"""Helpers shared by the training-data operators.

* ``materialize`` (from the library) cuts lineage by writing a Parquet table in
  the shared checkpoint folder: a lost executor costs a re-read, not a re-run.
* ``WordBatch`` turns an Arrow batch of texts into numpy arrays of words and
  64-bit word hashes without a Python loop over words.
* ``word_pieces`` feeds texts to it in pieces of bounded size: a long text comes
  in several pieces that end between words, so the working set of a worker does
  not grow with the length of a text. A single word of CHUNK_BYTES or more
  stands as its digest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.batches import frugal, small_batches  # noqa: F401  (their users import them from here)
from foliospark.session import discard, materialize  # noqa: F401  (their users import them from here)

#: Ids are sent to every executor only up to this count (about 100 MB as a hash
#: relation of longs); beyond it the same join shuffles instead.
BROADCAST_IDS = 4_000_000
#: Bits of the bitmap that stands for more ids (128 MB at most).
FILTER_BITS = 1 << 30

#: Bytes and rows of text that ``text_chunks`` puts into one numpy working set.
CHUNK_BYTES, CHUNK_ROWS = 1 << 18, 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until ``df`` has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def _marked(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, str]:
    """Adds a column (its name comes too): whether the key may be among ``ids``
    (false: it is not).

    A bitmap of eight or more bits an id, made by aggregation, is broadcast; it
    never exceeds FILTER_BITS, so rows are never shuffled to be told apart.
    """
    size, n = 1 << 15, ids.count()
    while size < FILTER_BITS and size < 8 * n:
        size *= 2
    may, place, word, bits = unused(df, "_may", "_place", "_word", "_bits")
    at = F.pmod(F.xxhash64(key), F.lit(size))
    one = ids.select(at.alias(place)).groupBy(F.expr(f"{place} div 32768").alias(word)).agg(F.bitmap_construct_agg(F.expr(f"{place} % 32768")).alias(bits))
    joined = df.withColumn(place, at).withColumn(word, F.expr(f"{place} div 32768")).join(F.broadcast(one), word, "left")
    byte = F.conv(F.hex(F.expr(f"substring({bits}, cast({place} % 32768 div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr(f"cast({place} % 8 as int)")
    return joined.withColumn(may, F.coalesce(F.getbit(byte, bit) == 1, F.lit(False)) & F.col(key).isNotNull()).select(*df.columns, may), may


def may_hold(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is in ``ids``, and some others; no shuffle."""
    if ids.count() <= BROADCAST_IDS:
        return df.join(F.broadcast(ids.select(key)), key, "left_semi").select(*df.columns)
    marked, may = _marked(df, ids, key)
    return marked.filter(F.col(may)).drop(may)


def without(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``ids``. Beyond the size that is
    broadcast, only rows that a bitmap cannot rule out are shuffled."""
    if ids.count() <= BROADCAST_IDS:
        return df.join(F.broadcast(ids.select(key)), key, "left_anti").select(*df.columns)
    marked, may = _marked(df, ids, key)
    rest = marked.filter(F.col(may)).join(ids.select(key), key, "left_anti")
    return marked.filter(~F.col(may)).select(*df.columns).unionAll(rest.select(*df.columns))


def join_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Inner join on ``key``; ``ids`` is broadcast if its count is small enough,
    else rows that a bitmap rules out go before the join shuffles."""
    if ids.count() <= BROADCAST_IDS:
        return df.join(F.broadcast(ids), key)
    return may_hold(df, ids, key).join(ids, key)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def bucket(col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as '')."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def unit_hash(*cols: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the columns and the seed alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


# ------------------------------------------------------------------ numpy words

_STEP = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i < n."""
    if len(_POWERS[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, base in ((0, _BASE), (1, inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * _STEP
    return x ^ (x >> np.uint64(29))


def text_chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer text forms its own range."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    total, first = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > first and total + size > most or k - first >= CHUNK_ROWS:
            yield first, k
            first, total = k, 0
        total += size
    if len(sizes):
        yield first, len(sizes)


_WHITE = re.compile(r"\s")


def text_parts(text: str, most: int = CHUNK_BYTES) -> Iterator[str]:
    """A text in parts of about ``most`` characters that end before white space."""
    at = 0
    while len(text) - at > most:
        cut = _WHITE.search(text, at + most)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class WordBatch:
    """Words of some texts as arrays.

    A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, with A-Z
    lower-cased. ``doc`` gives each word's row, ``first`` each row's first word
    (length rows + 1), ``starts``/``ends`` its bytes in ``data``.
    """

    def __init__(self, texts: pa.Array, lower: bool = True):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        n, rows = len(raw), len(texts)
        offsets = offsets - offsets[0]
        self.raw = raw
        self.data = data = _LOWER[raw] if lower else raw
        space = _SPACE[data]
        inner = np.empty(n + 1, bool)  # a word may go on from byte k-1 to k
        inner[0] = inner[n] = False
        inner[1:n] = ~space[:-1]
        inner[offsets] = False
        solid = np.append(~space, False)
        self.starts = np.flatnonzero(solid & ~inner)
        closes = np.empty(n + 1, bool)
        closes[1:] = solid[:n]
        closes[0] = False
        keeps = solid.copy()
        keeps[offsets] = False
        self.ends = np.flatnonzero(closes & ~keeps)
        self.first = np.searchsorted(self.starts, offsets)
        self.rows = rows
        power, self._inverse = _powers(n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[:n], out=self._sums[1:])

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.first))

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._inverse[starts] + (ends - starts).astype(np.uint64))

    def word_hash(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)


class Piece(NamedTuple):
    """Words of rows ``lo`` to ``hi`` (exclusive). Those from ``begin`` to ``end``
    are new, others are there for context; ``before`` words of the text (of a
    single long row) came in earlier pieces."""

    lo: int
    hi: int
    words: WordBatch
    begin: int
    end: int
    before: int


_GAP = re.compile(rb"[\x09-\x0d\x20]+")
_GIANT = re.compile(rb"(?<![^\x09-\x0d\x20])[^\x09-\x0d\x20]{%d,}" % CHUNK_BYTES)


def word_pieces(texts: pa.Array, ahead: int = 0) -> Iterator[Piece]:
    """All words of ``texts`` in pieces of at most about twice CHUNK_BYTES. The
    pieces of a long text hold one word before and ``ahead`` words after the new
    ones."""
    for lo, hi in text_chunks(texts):
        part = texts.slice(lo, hi - lo)
        size = pc.binary_length(part[0]).as_py() or 0 if hi - lo == 1 else 0
        if size <= CHUNK_BYTES:
            words = WordBatch(part)
            yield Piece(lo, hi, words, 0, len(words.starts), 0)
            continue
        # a word of such a length has a digest for all that is asked of it
        text = _GIANT.sub(lambda m: b"\x01" + blake2b(m[0].lower(), digest_size=16).hexdigest().encode(), part[0].as_buffer().to_pybytes())
        after = re.compile(rb"(?:[^\x09-\x0d\x20]+[\x09-\x0d\x20]*){0,%d}" % ahead)
        at = back = before = 0
        while at < len(text):
            gap = _GAP.search(text, min(len(text), at + CHUNK_BYTES))
            stop = gap.end() if gap else len(text)
            words = WordBatch(pa.array([text[back : after.match(text, stop).end()]], pa.large_binary()).cast(pa.large_string()))
            begin, end = np.searchsorted(words.starts, [at - back, stop - back]).tolist()
            yield Piece(lo, hi, words, begin, end, before)
            before += end - begin
            back, at = (back + int(words.starts[end - 1]) if end > begin else at), stop


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and each row's first word (length rows + 1)."""
    found, counts = [], np.zeros(len(texts) + 1, np.int64)
    for piece in word_pieces(texts):
        found.append(piece.words.word_hash()[piece.begin : piece.end])
        counts[piece.lo + 1 : piece.hi + 1] += np.diff(np.clip(piece.words.first, piece.begin, piece.end))
    return np.concatenate(found) if found else np.empty(0, np.uint64), np.cumsum(counts)


def window_hash(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, factor = np.zeros(n, np.uint64), 0x9E3779B97F4A7C15
    for k in range(width):
        out += words[k : k + n] * np.uint64(pow(factor, k + 1, 1 << 64))
    return mix(out)
