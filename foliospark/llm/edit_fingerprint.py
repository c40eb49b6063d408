"""Document fingerprints by randomised edit embedding.

All texts follow shared random walks over their characters: at step j the walk
puts out the character it stands on and moves on if a random bit of (j,
character) says so. Texts at small edit distance meet again after an edit, so
edit distance becomes Hamming distance between the outputs. The fingerprint
samples bits (four of a character's hash) of the output at fixed steps, equally
many in every octave, so one set of steps serves texts of all lengths. Bands of
bits, sampled by the steps that they stand for, propose near copies, which are
verified on the whole fingerprint.

Defined results: null text counts as empty; empty text has the fingerprint ''
(likeness 1 with another empty one, else 0); equal texts have equal
fingerprints; a very long text walks alone, whole; rows of one id are ordered by
text; a null id sorts first; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import frugal, materialize, small_batches, table
from foliospark.llm.components import connected_components

SEED = 424242
#: Sampled steps below 2**FIRST_OCTAVE are all of them, and SAMPLES per octave.
FIRST_OCTAVE, SAMPLES, OCTAVES = 6, 64, 40
#: The random bits repeat after so many steps.
PERIOD = 8192
#: Characters that walk side by side (a longer text walks alone), and that are
#: encoded at a time.
BATCH_CHARS, SLICE = 6_000_000, 500_000
#: Buckets of consecutive documents for the successor of every document: one for
#: about so many characters, and at most so many.
BUCKET_CHARS, MOST_BUCKETS = 64_000_000, 65_536
#: Bands of a fingerprint, and samples in a band: of two prints with likeness 0.8
#: about 1 - (1 - 0.8 ** 8) ** 24 = 0.99 share a band.
BANDS, BAND, THRESHOLD = 24, 8, 0.8
#: Members of a band that are paired with each other in one piece of a join.
BLOCK = 256

_rng = np.random.default_rng(SEED)
_MOVES = _rng.integers(0, 2, (PERIOD, 256), dtype=np.uint8)
_MOVES[:, 0] = 0  # the end of a text: stay
_NIBBLE = _rng.integers(0, 16, 256, dtype=np.uint8)
_NIBBLE[0] = 255
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def sampled_steps(octaves: int = OCTAVES) -> np.ndarray:
    """Steps whose output is kept, ascending."""
    rng = np.random.default_rng(SEED + 1)
    steps = [np.arange(1 << FIRST_OCTAVE)]
    for k in range(FIRST_OCTAVE, octaves):
        steps.append(np.sort(np.unique(rng.integers(1 << k, 1 << (k + 1), 2 * SAMPLES))[: 2 * SAMPLES : 2][:SAMPLES]))
    return np.concatenate(steps)


STEPS = sampled_steps()
#: Samples of the first steps, and of these and so many octaves.
ENDS = np.searchsorted(STEPS, 1 << np.arange(FIRST_OCTAVE, OCTAVES + 1)).tolist()
#: Steps that a sample stands for.
WEIGHTS = np.where(STEPS < 1 << FIRST_OCTAVE, 1.0, 2.0 ** np.floor(np.log2(np.maximum(STEPS, 1))) / SAMPLES)


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprints of ``texts``; texts of similar total size together."""
    out, first, total = [""] * len(texts), 0, 0
    for k, text in enumerate(texts):
        if total and total + len(text) > BATCH_CHARS:
            out[first:k] = _walk(texts[first:k])
            first, total = k, 0
        total += len(text)
    out[first:] = _walk(texts[first:])
    return out


def _slices(texts: list[str]) -> Iterator[str]:
    """The texts, each ended by a zero, in strings of about SLICE characters."""
    held, size = [], 0
    for text in texts:
        text = text.replace("\0", " ")
        for at in range(0, len(text), SLICE):
            held.append(text[at : at + SLICE])
            size += len(held[-1])
            if size >= SLICE:
                yield "".join(held)
                held, size = [], 0
        held.append("\0")
    yield "".join(held)


def _walk(texts: list[str]) -> list[str]:
    order = sorted((k for k, t in enumerate(texts) if t), key=lambda k: -len(texts[k]))
    if not order:
        return [""] * len(texts)
    lengths = np.array([len(texts[k]) + 1 for k in order], np.int64)
    codes = np.empty(lengths.sum(), np.uint8)
    filled = 0
    for part in _slices([texts[k] for k in order]):
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes[filled : filled + len(points)] = np.where(points == 0, 0, np.maximum((points * np.uint32(2654435761)) >> np.uint32(24), 1))
        filled += len(points)
    at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    rows = np.arange(len(order))
    samples: list[tuple[np.ndarray, np.ndarray]] = []
    step = k = 0
    while len(at):
        stop = int(STEPS[k]) if k < len(STEPS) else step + 4096
        stop = min(stop, step + 256)
        here = np.empty(len(at), np.uint8)
        move = np.empty(len(at), np.uint8)
        for j in range(step, stop):
            codes.take(at, out=here, mode="clip")
            _MOVES[j % PERIOD].take(here, out=move, mode="clip")
            at += move
        step = stop
        if k < len(STEPS) and step == STEPS[k]:
            samples.append((rows, _NIBBLE[codes[at]]))
            k += 1
        going = codes[at] != 0
        if not going.all():
            at, rows = at[going], rows[going]
    # every text stays until its end, so its samples are the first ones
    counts = np.zeros(len(order), np.int64)
    marks = np.full((len(order), len(samples)), 255, np.uint8)
    for s, (r, nibble) in enumerate(samples):
        marks[r, s] = nibble
        counts[r[nibble != 255]] = s + 1
    out = [""] * len(texts)
    for r, k in enumerate(order):
        out[k] = _HEX[marks[r, : counts[r]]].tobytes().decode()
    return out


def likeness(a: str, b: str) -> float:
    """Weighted share of equal samples, from 0 to 1."""
    if a == b:
        return 1.0
    x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
    n = min(len(x), len(y))
    same = WEIGHTS[:n][x[:n] == y[:n]].sum()
    return float(same / WEIGHTS[: max(len(x), len(y))].sum())


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` for every row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints([t or "" for t in batch.column(1).to_pylist()]), pa.string())], ["doc_id", "fingerprint"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")).mapInArrow(frugal(run), "doc_id long, fingerprint string")


def band_places(octaves: int) -> list[list[int]]:
    """Samples of each band for prints that reach so many octaves: drawn by the
    steps that they stand for, as likeness counts them."""
    rng, most = np.random.default_rng(SEED + 2 + octaves), ENDS[octaves]
    share = WEIGHTS[:most] / WEIGHTS[:most].sum()
    return [np.sort(rng.choice(most, BAND, replace=False, p=share)).tolist() for _ in range(BANDS)]


def bands_of(nodes: DataFrame) -> DataFrame:
    """``node, band`` of rows (node, fingerprint). A print whose last octave is
    not half full also has the bands of the octaves before it, as a near copy
    may end there."""
    places = nodes.sparkSession.createDataFrame([(k, b, p) for k in range(len(ENDS)) for b, p in enumerate(band_places(k))], "octaves int, b int, places array<int>")
    ends, n = F.array(*map(F.lit, ENDS)), F.length("fingerprint")
    last = F.size(F.filter(ends, lambda e: e < n))
    short = (last > 0) & (2 * n < F.get(ends, last) + F.get(ends, last - 1))
    each = nodes.select("node", "fingerprint", F.explode(F.when(short, F.array(last, last - 1)).otherwise(F.array(last))).alias("octaves"))
    bits = F.transform("places", lambda p: F.substring("fingerprint", p + 1, F.lit(1)))
    return each.join(F.broadcast(places), "octaves").select("node", F.xxhash64("octaves", "b", F.concat_ws(",", bits)).alias("band"))


def near_copies(prints: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id``: documents joined by verified band matches.

    ``prints`` holds ``doc_id, fingerprint``. Equal fingerprints are one node.
    Every node is first verified against the first node of each of its bands.
    Pairs of a band that are still in different components are then all verified,
    so every pair with a common band is linked if it is alike; bands with many
    members are split into blocks of about BLOCK members, and pairs of blocks are
    joined.
    """
    nodes = materialize(prints.filter("doc_id is not null and fingerprint <> ''").groupBy("fingerprint").agg(F.min("doc_id").alias("node")), "prints")
    bands = bands_of(nodes)
    firsts = bands.groupBy("band").agg(F.min("node").alias("a"), F.count("*").alias("c")).filter("c > 1").select("band", "a")
    pairs = bands.join(firsts, "band").filter("node <> a").select("a", F.col("node").alias("b")).distinct()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [likeness(x, y) >= threshold for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(nodes.select(F.col("node").alias("a"), F.col("fingerprint").alias("fa")), "a").join(nodes.select(F.col("node").alias("b"), F.col("fingerprint").alias("fb")), "b")
        return both.select("a", "b", "fa", "fb").mapInArrow(frugal(check), "a long, b long")

    links = materialize(verified(pairs), "print-links")
    parts = connected_components(links, "prints")
    member = bands.join(parts, "node", "left").select("band", "node", F.coalesce("component", "node").alias("c"))
    mixed = member.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n")).filter("lo <> hi").select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("k"))
    left = materialize(member.join(mixed, "band").withColumn("i", F.pmod(F.xxhash64("node"), F.col("k")).cast("int")), "print-rest")
    # every pair of blocks meets once, in the piece (lesser block, greater block)
    pieces = left.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select("band", "node", "c", "i", F.least("i", "j").alias("p"), F.greatest("i", "j").alias("q"))
    x, y = (pieces.select("band", "p", "q", F.col("node").alias(u), F.col("c").alias(f"c{u}"), F.col("i").alias(f"i{u}")) for u in ("a", "b"))
    rest = x.join(y, ["band", "p", "q"]).filter("a < b and ca <> cb and (p = q or ia <> ib)").select("a", "b").distinct()
    more = materialize(verified(rest), "print-more")
    parts = connected_components(links.unionAll(more), "prints-all")
    named = nodes.join(parts, "node", "left").select("fingerprint", F.coalesce("component", "node").alias("c"))
    return prints.join(named, "fingerprint", "left").select("doc_id", F.coalesce("c", "doc_id").alias("class_id"))


def _bucket(key: Column, bounds: list[int]) -> Column:
    """Number of ``bounds`` (ascending) not above ``key``, by binary search."""
    if not bounds:
        return F.lit(0)
    array, n = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>"), len(bounds)  # folded into one literal

    def halve(acc: Column, _: Column) -> Column:
        mid = ((acc["lo"] + acc["hi"]) / 2).cast("int")
        right = (acc["lo"] < acc["hi"]) & (F.get(array, mid) <= key)
        return F.struct(F.when(right, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(right | (acc["lo"] >= acc["hi"]), acc["hi"]).otherwise(mid).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length() + 1)), start, halve, lambda acc: acc["lo"])


def with_successor(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (bucket, ahead, doc_id, t), partitioned and sorted so that each
    document is followed by its successor by id; rows with ``ahead`` = 1 are
    there to be followed only.

    Buckets are ranges of ids with about equally many documents. The first
    document of each bucket is copied to the end of the bucket before it, so
    texts are shuffled once and no task sees all documents.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chars = rows.agg(F.sum(F.length("t")).alias("n")).first()["n"] or 0
    n = min(MOST_BUCKETS, max(4 * parts, -(-chars // BUCKET_CHARS)))
    bounds = rows.select(F.percentile_approx(key, [k / n for k in range(1, n)], 20 * n).alias("q")).first()["q"] or []
    bounds = sorted(set(bounds))
    placed = rows.withColumn("bucket", _bucket(key, bounds))
    firsts = sorted((r["bucket"], r["first"]) for r in placed.groupBy("bucket").agg(F.min(key).alias("first")).collect())  # at most MOST_BUCKETS rows
    ahead = spark.createDataFrame([(firsts[k - 1][0], first) for k, (_, first) in enumerate(firsts)], "bucket int, first long")
    copies = rows.join(F.broadcast(ahead), key == F.col("first")).select("bucket", F.lit(1).alias("ahead"), "doc_id", "t")
    every = placed.select("bucket", F.lit(0).alias("ahead"), "doc_id", "t").unionAll(copies)
    return every.repartition(max(parts, n // 4), "bucket").sortWithinPartitions("bucket", "ahead", "doc_id", "t")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, int | None, str]]]:
    """Lists of rows of at most BATCH_CHARS / 2 characters; the last row of a
    list is the first of the next one."""
    held: list = []
    size = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append(row)
            size += len(row[3])
            if size > BATCH_CHARS // 2 and len(held) > 1:
                yield held
                held, size = [row], len(row[3])
    if held:
        yield held


def compare_with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited forms (see the query)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            texts, edited = [r[3] for r in rows], []
            live = [k for k in range(len(rows) - 1) if not rows[k][1] and rows[k + 1][0] == rows[k][0]]
            for k in live:
                cut = len(texts[k]) // 4
                edited.append(texts[k][: len(texts[k]) - cut] + texts[k + 1][:cut])
            own, changed = fingerprints(texts), fingerprints(edited)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[k][2] for k in live], pa.int64()),
                    pa.array([len(texts[k]) for k in live], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf8", "replace")).hexdigest() for t in edited], pa.string()),
                    pa.array([own[k] for k in live], pa.string()),
                    pa.array(changed, pa.string()),
                    pa.array([likeness(own[k], c) for k, c in zip(live, changed, strict=True)], pa.float64()),
                    pa.array([likeness(own[k], own[k + 1]) for k in live], pa.float64()),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    small_batches(docs.sparkSession)
    return with_successor(docs, id_col, text_col).select("bucket", "ahead", "doc_id", "t").mapInArrow(frugal(run), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op8_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edited(table(spark, sf_dir, "documents"))


QUERIES = {"op8_edit_fingerprint": op8_edit_fingerprint}
