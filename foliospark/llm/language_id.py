"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of one fixed public
vocabulary. A word's probability under a language is the sum over all its
segmentations into pieces, computed by the forward algorithm; a text's is the
product over its words. Piece probabilities are learned by expectation
maximisation: every round, tasks sum up the expected counts (forward-backward)
of the words of a bounded sample of labelled documents.

Defined results: null text or text without a letter gives ``und`` with score
0; languages that are equally likely give the first by name; a very long text
is scored in parts, as a whole; an empty table gives an empty table; rows whose
id is null count as bucket 0; repeated rows repeat; other columns of the input
are ignored. With no labelled row at all, every prediction is ``und``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import bucket, frugal, materialize, small_batches, table, text_chunks, text_parts, unit_hash

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Bound of the training sample: about so many documents of each language,
#: chosen by a hash of the id.
TRAIN_DOCS = 400
EM_ROUNDS = 3
#: Expected count that every piece gets in every language (smoothing).
PRIOR = 0.05
#: Probability of a character that the vocabulary lacks, in every language.
UNKNOWN = 1e-7
#: Words that a worker remembers (about 150 bytes each) before it starts anew.
MEMO_WORDS = 600_000
#: Words shorter than this go through the lattice together, so many at once.
SHORT, STEP_WORDS = 32, 20_000
#: Positions after which sums over a word are scaled anew.
STRIDE = 24


def load_pieces(model: str) -> dict[str, int]:
    from sentencepiece import SentencePieceProcessor

    path = model
    if "/" not in model:
        import public_tokenizers

        path = public_tokenizers.path(model)
    sp = SentencePieceProcessor(model_file=path)
    return {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}


def words_of(text: str) -> list[str]:
    return text.lower().split()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Lattice:
    """Forward (and backward) sums over the segmentations of single words."""

    pieces: dict[str, int]
    longest: int = 0
    #: Pieces by text, and -1 for texts that only begin a piece.
    known: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)
        self.known = {p[:k]: -1 for p in self.pieces for k in range(1, len(p))} | self.pieces

    def edges(self, word: str) -> list[tuple[int, int, int]]:
        """(start, end, piece or -1) of the marked word, by start."""
        s, found, get = MARK + word, [], self.known.get
        n = len(s)
        for i in range(n):
            if get(s[i], -1) < 0:
                found.append((i, i + 1, -1))
            for j in range(i + 1, n + 1):
                k = get(s[i:j])
                if k is None:
                    break
                if k >= 0:
                    found.append((i, j, k))
        return found

    def forward(self, word: str, probs: np.ndarray) -> np.ndarray:
        """Log of the summed probability under every language. What is held is
        the sums of the positions that a piece can reach from the last one."""
        s, get = MARK + word, self.known.get
        n, width = len(s), probs.shape[1]
        alpha: dict[int, np.ndarray] = {0: np.ones(width)}
        log = np.zeros(width)
        for i in range(n):
            here = alpha.pop(i)
            if i % STRIDE == STRIDE - 1:  # keep the numbers in range over long words
                log += np.log(here)
                for m in alpha:
                    alpha[m] = alpha[m] / here
                here = np.ones(width)
            if get(s[i], -1) < 0:
                alpha[i + 1] = alpha.get(i + 1, 0) + here * UNKNOWN
            for j in range(i + 1, n + 1):
                k = get(s[i:j])
                if k is None:
                    break
                if k >= 0:
                    alpha[j] = alpha.get(j, 0) + here * probs[k]
        return log + np.log(alpha[n])

    def forward_all(self, words: list[str], probs: np.ndarray) -> np.ndarray:
        """``forward`` of many words at once: edges between the same two
        positions are added in one step for all words that have them."""
        out = np.empty((len(words), probs.shape[1]))
        short = [k for k, w in enumerate(words) if len(w) < SHORT]
        for k in set(range(len(words))).difference(short) if len(short) < len(words) else ():
            out[k] = self.forward(words[k], probs)
        if not short:
            return out
        flat: list[int] = []
        add, get = flat.append, self.known.get
        for at, k in enumerate(short):
            s = MARK + words[k]
            n = len(s)
            for i in range(n):
                base = (i << 48) | (at << 16)
                if get(s[i], -1) < 0:
                    add(((i + 1) << 54) | base | 0xFFFF)
                for j in range(i + 1, n + 1):
                    piece = get(s[i:j])
                    if piece is None:
                        break
                    if piece >= 0:
                        add((j << 54) | base | piece)
        edges = np.sort(np.array(flat, np.int64))
        step, row, piece = edges >> 48, (edges >> 16) & 0xFFFFFFFF, edges & 0xFFFF
        factor = np.where((piece == 0xFFFF)[:, None], UNKNOWN, probs[np.minimum(piece, len(probs) - 1)])
        alpha = np.zeros((SHORT + 1, len(short), probs.shape[1]))
        alpha[0] = 1.0
        cuts = np.flatnonzero(np.diff(step, prepend=-1, append=-1))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            i, j = int(step[lo]) & 63, int(step[lo]) >> 6
            alpha[j, row[lo:hi]] += alpha[i, row[lo:hi]] * factor[lo:hi]
        ends = np.array([len(words[k]) + 1 for k in short])
        out[short] = np.log(alpha[ends, np.arange(len(short))])
        return out

    def expected(self, word: str, weight: float, p: np.ndarray, counts: np.ndarray) -> None:
        """Add the word's expected piece counts under one language.

        Every STRIDE positions the sums so far are divided by the one that has
        been reached; an edge across such a place has its weight divided, which
        leaves the expected counts as they are and every number in range.
        """
        n, edges = len(word) + 1, self.edges(word)
        alpha, beta = [0.0] * (n + 1), [0.0] * (n + 1)
        alpha[0] = beta[n] = 1.0
        weights, scale = [], {}
        for i, j, k in edges:
            if i % STRIDE == 0 and i and i not in scale:
                scale[i] = alpha[i]
                for m in range(i, min(n, i + self.longest) + 1):
                    alpha[m] /= scale[i]
            w = p[k] if k >= 0 else UNKNOWN
            alpha[j] += alpha[i] * w
            weights.append(w)
        if scale:
            for e, (i, j, _) in enumerate(edges):
                place = (i // STRIDE + 1) * STRIDE
                while place <= j and place < n:
                    weights[e] /= scale[place]
                    place += STRIDE
        for (i, j, _), w in zip(reversed(edges), reversed(weights), strict=True):
            beta[i] += beta[j] * w
        for (i, j, k), w in zip(edges, weights, strict=True):
            if k >= 0:
                counts[k] += weight * alpha[i] * w * beta[j] / alpha[n]


@dataclass
class LanguageModel:
    langs: list[str]
    probs: np.ndarray  # pieces x languages
    prior: np.ndarray  # log share of each language among the labelled rows
    model: str

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Scores texts; remembers words that it has seen."""

    def __init__(self, lm: LanguageModel):
        self.lm, self.lattice = lm, Lattice(load_pieces(lm.model))
        self.memo: dict[str, int] = {}
        self.rows = np.zeros((1024, len(lm.langs)))

    def index(self, words: list[str]) -> np.ndarray:
        memo = self.memo
        return np.fromiter(map(memo.__getitem__, words), np.int64, len(words))

    def learn(self, words: set[str]) -> None:
        """Put all of ``words`` into the memo; if it is full, it starts anew."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        fresh = list(words.difference(self.memo))
        for lo in range(0, len(fresh), STEP_WORDS):
            part, k = fresh[lo : lo + STEP_WORDS], len(self.memo)
            while k + len(part) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[k : k + len(part)] = self.lattice.forward_all(part, self.lm.probs)
            self.memo.update(zip(part, range(k, k + len(part)), strict=True))

    def score_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Texts as ``text_chunks`` gives them: short ones, or one long one."""
        live = [bool(t and self.lm.langs and has_letter(t)) for t in texts]
        sums = np.tile(self.lm.prior, (len(texts), 1))
        if len(texts) == 1 and live[0]:
            for part in text_parts(texts[0]):
                words = words_of(part)
                self.learn(set(words))
                sums[0] += self.rows[self.index(words)].sum(axis=0)
        else:
            lists = [words_of(t) if ok else [] for t, ok in zip(texts, live, strict=True)]
            self.learn(set().union(*lists))
            for k, words in enumerate(lists):
                sums[k] += self.rows[self.index(words)].sum(axis=0)
        return [self.chosen(x) if ok else ("und", 0.0) for x, ok in zip(sums, live, strict=True)]

    def chosen(self, total: np.ndarray) -> tuple[str, float]:
        best = int(total.argmax())
        return self.lm.langs[best], float(1.0 / np.exp(total - total[best]).sum())


def fit(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = TRAIN_DOCS) -> LanguageModel:
    """Learn from the labelled rows of ``docs``.

    The share of each language is counted over all of them; piece
    probabilities come from all words of about ``per_lang`` documents a
    language. The driver holds a number for each piece and language.
    """
    small_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).filter("l is not null and t is not null")
    shares = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return LanguageModel([], np.zeros((1, 0)), np.zeros(0), model)
    fraction = F.element_at(F.create_map(*[F.lit(x) for lang, n in shares.items() for x in (lang, min(1.0, per_lang / n))]), F.col("l"))
    sample = rows.filter(unit_hash(F.col("i"), seed=3) < fraction).select("l", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for lang, words in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), pa.array(list(words)), pa.array(list(words.values()), pa.int64())], ["l", "w", "n"])
            found.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for part in text_parts(text):
                    found.setdefault(lang, Counter()).update(words_of(part))
                    if sum(map(len, found.values())) > MEMO_WORDS // 4:
                        yield from told()
        yield from told()

    totals = sample.mapInArrow(frugal(count), "l string, w string, n long").groupBy("l", "w").agg(F.sum("n").alias("n"))
    totals = materialize(totals.repartition(sc.defaultParallelism), "lang-words")
    langs, size = sorted(shares), max(load_pieces(model).values(), default=0) + 1
    probs = np.full((size, len(langs)), 1.0 / size)
    for _ in range(EM_ROUNDS):
        counts = np.full((size, len(langs)), PRIOR)
        for lang, piece, c in expected_counts(totals, LanguageModel(langs, probs, np.zeros(len(langs)), model)).toPandas().itertuples(index=False):
            counts[piece, langs.index(lang)] += c
        probs = counts / counts.sum(axis=0)
    total = sum(shares.values())
    return LanguageModel(langs, probs, np.array([math.log(shares[x] / total) for x in langs]), model)


def expected_counts(totals: DataFrame, lm: LanguageModel) -> DataFrame:
    """``l, piece, c``: expected counts of the words (l, w, n) under ``lm``; a
    row for each piece and language at most."""
    shared = totals.sparkSession.sparkContext.broadcast(lm)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, lattice = shared.value, Lattice(load_pieces(shared.value.model))
        plain = {lang: model.probs[:, k].tolist() for k, lang in enumerate(model.langs)}
        counts = {lang: np.zeros(len(model.probs)) for lang in model.langs}
        for batch in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lattice.expected(word, n, plain[lang], counts[lang])
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at])], ["l", "piece", "c"])

    return totals.select("l", "w", "n").mapInArrow(frugal(run), "l string, piece int, c double").groupBy("l", "piece").agg(F.sum("c").alias("c"))


_SCORERS: dict[int, Scorer] = {}


def identify(docs: DataFrame, lm: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; the model (vocabulary size x
    languages numbers) goes to each executor once as a broadcast variable."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lm)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = id(shared.value)  # the scorer holds the model, so the id stays taken
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = shared.value.scorer()
        score_all = _SCORERS[key].score_all
        for batch in (b.slice(lo, hi - lo) for b in batches for lo, hi in text_chunks(b.column(2))):
            found = score_all(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (bucket(F.col(id_col), 4) == 2).alias("held_out"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(frugal(run), "doc_id long, held_out boolean, lang_pred string, score double")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs.filter(bucket(F.col("doc_id"), 4) != 2)))


QUERIES = {"op3_language_id": op3_language_id}
