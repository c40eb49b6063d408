import itertools
import math

import numpy as np

from foliospark.llm.common import bucket
from foliospark.llm import language_id
from foliospark.llm.language_id import MODEL, UNKNOWN, Lattice, fit, has_letter, identify
from pyspark.sql import functions as F

TEXTS = {"en": "the house and the garden with a tree", "de": "das haus und der garten mit einem baum", "fr": "la maison et le jardin avec un arbre"}


def test_forward_sums_all_segmentations():
    pieces = {"▁": 0, "a": 1, "b": 2, "▁a": 3, "ab": 4, "▁ab": 5}
    probs = np.random.default_rng(1).uniform(0.1, 1, (6, 2))
    lattice = Lattice(pieces)
    for word in ("ab", "aab", "ba", "axb", "a" * 40):
        marked = "▁" + word
        total = np.zeros(2)
        if len(marked) < 12:
            for cuts in itertools.product((0, 1), repeat=len(marked) - 1):
                at = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(marked)]
                parts = [marked[x:y] for x, y in itertools.pairwise(at)]
                if all(p in pieces or p == "x" for p in parts):
                    total += np.prod([probs[pieces[p]] if p in pieces else np.full(2, UNKNOWN) for p in parts], axis=0)
            assert np.allclose(np.log(total), lattice.forward(word, probs))
        assert np.allclose(lattice.forward_all([word], probs)[0], lattice.forward(word, probs))


def test_held_out_accuracy_and_odd_rows(spark):
    rows = [(k, f"{TEXTS[lang]} {k}", lang) for k in range(300) for lang in [list(TEXTS)[k % 3]]]
    rows += [(1000, None, "en"), (1001, "123 !?", "en"), (1002, "the garden " * 20000, None), (None, "das haus", None), (5, rows[5][1], rows[5][2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"score": F.lit(1), "l": F.lit(2)})
    model = fit(docs.filter(bucket(F.col("doc_id"), 4) != 2))
    got = identify(docs, model).collect()
    truth = {r[0]: r[2] for r in rows}
    assert all(r.lang_pred == truth[r.doc_id] for r in got if r.doc_id is not None and r.doc_id < 300)
    odd = {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id is None or r.doc_id >= 1000}
    assert odd[1000] == odd[1001] == ("und", 0.0) and odd[1002][0] == "en" and odd[None][0] == "de"
    assert len(got) == len(rows)


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "hello", None)], "doc_id long, text string, lang string")
    assert identify(docs, fit(docs)).first().lang_pred == "und"
    assert identify(docs.limit(0), fit(docs.limit(0), MODEL)).collect() == []


def test_expected_counts_equal_enumeration(monkeypatch):
    monkeypatch.setattr(language_id, "STRIDE", 3)
    pieces = {"▁": 0, "a": 1, "b": 2, "▁a": 3, "ab": 4, "▁ab": 5, "bab": 6}
    p = [0.3, 0.2, 0.1, 0.15, 0.1, 0.1, 0.05]
    for word in ("ab", "babab", "axbab", "ababbabab"):
        marked, mass, want = "▁" + word, 0.0, np.zeros(7)
        for cuts in itertools.product((0, 1), repeat=len(marked) - 1):
            at = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(marked)]
            parts = [marked[x:y] for x, y in itertools.pairwise(at)]
            if all(x in pieces or x == "x" for x in parts):
                weight = math.prod(p[pieces[x]] if x in pieces else UNKNOWN for x in parts)
                mass += weight
                for x in parts:
                    if x in pieces:
                        want[pieces[x]] += weight
        got = np.zeros(7)
        Lattice(pieces).expected(word, 2.0, p, got)
        assert np.allclose(got, 2.0 * want / mass)


def test_long_words_have_expected_counts_too():
    got = np.zeros(3)
    Lattice({"▁": 0, "a": 1, "b": 2}).expected("x" * 500 + "ab" * 500, 1.0, [0.3, 0.2, 0.1], got)
    assert np.allclose(got, [1, 500, 500])


def test_letters():
    assert has_letter("½ é") and has_letter("中") and not has_letter("½ ² 3 _ !") and not has_letter("")
