"""Token counts by heap-and-linked-list byte-pair merging.

A text's count is its number of initial symbols minus the merges made. The
merges of a symbol list repeatedly take the adjacent pair of lowest rank (the
leftmost among equals) from a heap; a doubly linked list keeps the neighbours.
No identifiers are produced.

No vocabulary piece holds a word mark after another character, nor a symbol
outside the vocabulary, so merges never cross those places: a text is counted
word by word and equal words are counted once per worker (bounded memo).

Defined results: a null text counts as empty; an empty text has 0 tokens;
repeated rows give repeated rows; a very long text is counted in parts cut at
such places; ties of rank go to the leftmost pair; an empty table gives an empty
table; other columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import frugal, small_batches, table, text_or_empty

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: Words that a worker remembers (about 100 bytes each) before it starts anew.
MEMO_WORDS = 500_000
MARK = "▁"
#: Characters of a long text that are split into words at a time, and the words
#: from which runs are cut where no piece of the vocabulary can lie across.
PART, LONG_RUN = 1 << 18, 512
_CUT = re.compile(f"(?<=[^ {MARK}\n]) |\n")


class Memo(dict):
    """Tokens of words that were seen before; forgets all when it is full."""

    def __init__(self, merge: Callable[[str], int], prefix: str):
        self.merge, self.prefix = merge, prefix

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = n = self.merge(self.prefix + word)
        return n


class MergeCounter:
    """Counts tokens for the ranks of one sentence-piece BPE model."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model_path)
        pieces = [(sp.get_score(i), sp.id_to_piece(i)) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.rank = {piece: k for k, (_, piece) in enumerate(sorted(pieces, key=lambda x: -x[0]))}
        self.pairs = {piece[k : k + 2] for piece in self.rank for k in range(len(piece) - 1)}
        self.splits = not any(MARK in piece.lstrip(MARK) or "\n" in piece for piece in self.rank)
        self.tail, self.word = Memo(self.merge, ""), Memo(self.merge, MARK)

    def merge(self, symbols: str) -> int:
        """Tokens of one run of symbols."""
        if len(symbols) < LONG_RUN:
            return self._merge(symbols)
        # two neighbours that no piece holds are never merged, nor are their runs
        total, first, pairs = 0, 0, self.pairs
        for k in range(1, len(symbols)):
            if symbols[k - 1 : k + 1] not in pairs:
                total += self._merge(symbols[first:k])
                first = k
        return total + self._merge(symbols[first:])

    def _merge(self, symbols: str) -> int:
        rank, n = self.rank, len(symbols)
        alive: list[str | None] = list(symbols)
        total = sum(1 if c in rank else len(c.encode()) for c in symbols)
        if n < 2:
            return total
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, 2) for k in range(n - 1) if (r := rank.get(symbols[k] + symbols[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, size = heapq.heappop(heap)
            left, at = alive[k], after[k]
            if left is None or at >= n or len(left) + len(alive[at]) != size:
                continue  # one of the two has gone or grown since
            alive[k] = joined = left + alive[at]
            alive[at] = None
            after[k] = nxt = after[at]
            total -= 1
            if nxt < n:
                before[nxt] = k
                if (r := rank.get(joined + alive[nxt])) is not None:
                    heapq.heappush(heap, (r, k, len(joined) + len(alive[nxt])))
            if (prev := before[k]) >= 0 and (r := rank.get(alive[prev] + joined)) is not None:
                heapq.heappush(heap, (r, prev, len(alive[prev]) + len(joined)))
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.splits:
            return self.merge(MARK + text.replace(" ", MARK))
        total = at = 0
        while at < len(text):
            cut = _CUT.search(text, at + PART) if len(text) - at > PART else None
            stop = cut.start() if cut else len(text)
            total += self._lines((MARK if at == 0 else "") + text[at:stop])
            at = stop
        return total

    def _lines(self, text: str) -> int:
        lines = text.split("\n")
        return len(lines) - 1 + sum(map(self._line, lines))  # a line end is one byte, thus one token

    def _line(self, line: str) -> int:
        if not line:
            return 0
        if "  " in line or MARK in line[1:] or line[0] == " " or line[:2] == MARK + " ":
            return sum(map(self.tail.__getitem__, re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", line.replace(" ", MARK))))
        head, *words = line.split(" ")
        return self.tail[head] + sum(map(self.word.__getitem__, words))


_COUNTERS: dict[str, MergeCounter] = {}


def counter_for(model: str) -> MergeCounter:
    """One counter per worker process; ``model`` is a path or a public name."""
    if model not in _COUNTERS:
        path = model
        if "/" not in model:
            import public_tokenizers

            path = public_tokenizers.path(model)
        _COUNTERS[model] = MergeCounter(path)
    return _COUNTERS[model]


def count_tokens(docs: DataFrame, model: str = MODEL, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter_for(model).count
        for batch in batches:
            n = [count(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    small_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text_or_empty(text_col)).cast("long").alias("n_bytes"), text_or_empty(text_col).alias("text"))
    return picked.mapInArrow(frugal(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


QUERIES = {"op1_token_counts": op1_token_counts}
