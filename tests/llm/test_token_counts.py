import random

import sentencepiece
from public_tokenizers import path

from foliospark.llm import token_counts
from foliospark.llm.token_counts import MODEL, count_tokens, counter_for

ODD = ["", " ", "  ", "a  b", "\n", "\n\n a", "▁", "▁▁ ▁x", "日本語 テスト", "<s> hi </s> <unk> <0x0A>", "a\tb", "x" * 5000, "  " * 50, "🙂🙂 ok", "\x00 a"]


def test_counts_equal_the_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=path(MODEL))
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice("ab ▁\n.é日  th") for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    assert [counter_for(MODEL).count(t) for t in texts] == [len(x) for x in sp.encode(texts)]


def test_rows_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a b", 5), (1, "a b", 5), (2, None, 6), (None, "x", 7), (3, "word " * 30000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(tuple(r) for r in count_tokens(docs).fillna({"doc_id": -1}).collect())
    assert [r[:3] for r in got][1:4] == [(1, 3, 2), (1, 3, 2), (2, 0, 0)]
    assert got[-1][3] is True and got[0][1:] == (1, 1, False)


def test_empty_table(spark):
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_texts_in_parts_equal_the_library(monkeypatch):
    monkeypatch.setattr(token_counts, "PART", 5)
    monkeypatch.setattr(token_counts, "LONG_RUN", 3)
    sp = sentencepiece.SentencePieceProcessor(model_file=path(MODEL))
    rnd = random.Random(2)
    texts = ODD + ["".join(rnd.choice("ab ▁\n.é日  th") for _ in range(rnd.randint(0, 90))) for _ in range(2000)]
    texts += ["".join(rnd.choice(["the", "ing", " ", "\n", "日本", "x", "  "]) for _ in range(60)) for _ in range(500)]
    counter = token_counts.MergeCounter(path(MODEL))
    assert [counter.count(t) for t in texts] == [len(x) for x in sp.encode(texts)]
