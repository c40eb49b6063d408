import random

import numpy as np
import pyarrow as pa

from foliospark.llm import quality, toxicity
from foliospark.llm.common import WordBatch, bucket, window_hash
from foliospark.llm.label_model import fit_label_model, fit_linear
from pyspark.sql import functions as F


def test_words_and_hashes_equal_plain_code():
    texts = ["Ab  c\n", None, "", " x", "é\tZ9", "a", "ab c"]
    b = WordBatch(pa.array(texts))
    got = [[b.data[b.starts[k] : b.ends[k]].tobytes().decode() for k in range(b.first[r], b.first[r + 1])] for r in range(b.rows)]
    assert got == [["ab", "c"], [], [], ["x"], ["é", "z9"], ["a"], ["ab", "c"]]
    h = b.word_hash()
    assert h[0] == h[-2] and h[1] == h[-1] and len(set(h.tolist())) == 6
    assert len(window_hash(h, 2)) == len(h) - 1 and len(window_hash(h[:1], 2)) == 0


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(4)
    truth = rng.random(20000) < 0.3
    votes = np.zeros((20000, 5), np.int64)
    right = (0.95, 0.9, 0.8, 0.7, 0.6)
    for v, p in enumerate(right):
        ok = rng.random(20000) < p
        votes[:, v] = np.where(rng.random(20000) < 0.2, 0, np.where(truth == ok, 2, 1))
    keys, counts = np.unique(votes, axis=0, return_counts=True)
    model = fit_label_model(keys, counts.astype(float), 0.5)
    assert abs(model.prior - 0.3) < 0.03 and np.allclose(model.accuracy(), right, atol=0.04)
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.93
    copied = np.concatenate([votes, votes[:, -1:], votes[:, -1:], votes[:, -1:]], axis=1)
    keys, counts = np.unique(copied, axis=0, return_counts=True)
    assert fit_label_model(keys, counts.astype(float), 0.3, correlated=True, fixed_prior=True).weight[-1] < 0.5


def test_linear_model():
    rows, cols = np.arange(200), np.arange(200) % 2
    w, bias = fit_linear(rows, cols, np.ones(200), (cols == 1).astype(float), 2)
    assert w[1] + bias > 2 > -2 > w[0] + bias
    assert fit_linear(rows[:0], cols[:0], np.ones(0), np.ones(0), 2)[1] == 0


def prose(rnd, words, n):
    return " ".join(rnd.choice(words) + rnd.choice(["", "", "", ".", ","]) for _ in range(n))


def test_toxicity_held_out(spark):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(2, 8))) for _ in range(2000)]
    docs, labels = [], []
    for k in range(1500):
        toxic = k % 6 == 0
        text = prose(rnd, words, rnd.randint(20, 120))
        if toxic:
            text += " " + " ".join(rnd.choice(["zorp" + rnd.choice(words), "idiot", "Grumbo!"]) for _ in range(3))
        docs.append((k, text))
        labels.append((k, int(toxic)))
    docs += [(5000, None), (5001, ""), (5002, "fine words " * 20000), (None, "fine"), (3, docs[3][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit(1), "t": F.lit(2), "y": F.lit(3)})
    lab = spark.createDataFrame([*labels, (7, None)], "doc_id long, toxic int")
    learn = bucket(F.col("doc_id"), 5) != 0
    model = toxicity.fit(d.filter(learn), lab.filter(learn))
    got = toxicity.score(d, model).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1500]
    assert held and sum(r.predicted != int(r.doc_id % 6 == 0) for r in held) <= 0.03 * len(held)
    assert all(r.predicted == 0 for r in got if r.doc_id is None or r.doc_id >= 5000)
    bare = toxicity.fit(d.limit(0), lab.limit(0))
    assert toxicity.score(d.limit(0), bare).collect() == []


def test_quality_finds_junk_and_keeps_short_prose(spark):
    rnd = random.Random(10)
    words = ["".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(2, 8))) for _ in range(2000)]
    docs = []
    for k in range(1200):
        kind = k % 12
        text = prose(rnd, words, rnd.choice([4, 12, 60, 300]))
        if kind == 0:
            text = " ".join(w + "###" for w in prose(rnd, words, 60).split())
        elif kind == 1:
            text = " ".join([rnd.choice(words)] * 80)
        docs.append((k, text))
    docs += [(5000, None), (5001, " \n"), (None, "some fine words here."), (5002, prose(rnd, words, 40000))]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit(1), "_score": F.lit(2)})
    model = quality.fit(d)
    got = {r.doc_id: r.good for r in quality.score(d, model).collect()}
    assert sum(got[k] for k in range(1200) if k % 12 < 2) <= 6
    assert sum(not got[k] for k in range(1200) if k % 12 >= 2) <= 10
    assert not got[5000] and not got[5001] and got[5002] and got[None]
    kept = quality.keep_good(d, model)
    assert kept.columns == d.columns and kept.count() == sum(got.values())
    assert quality.score(d.limit(0), quality.fit(d.limit(0))).collect() == []


def test_frequent_terms_and_copies(spark):
    rnd = random.Random(9)
    words = [f"w{k}x" for k in range(500)]
    some = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    few = words[:30]
    rows = [(k, f"{some(6)} {rnd.choice(few)} zorkblat {some(6)}", 1) for k in range(400)]
    rows += [(1000 + k, f"{some(6)} such a grumfik {some(6)}", 1) for k in range(200)]
    rows += [(2000 + k, f"{some(5)} an unchanged passage of plainish words {some(5)}", 1) for k in range(100)]
    rows += [(3000 + k, some(14), 0) for k in range(3000)]
    terms, _ = toxicity.induce_terms(spark.createDataFrame(rows, "i long, t string, y int"))
    listed = lambda w: toxicity.hash_words((w,))[0] in terms.hashes[terms.kinds == 0]
    assert listed("zorkblat") and listed("grumfik")
    assert not listed("plainish") and not listed("passage")


def test_label_model_equals_plain_em():
    """The same posterior by loops over documents and votes."""
    rng = np.random.default_rng(2)
    votes = rng.integers(0, 3, (60, 4))
    keys, counts = np.unique(votes, axis=0, return_counts=True)
    model = fit_label_model(keys, counts.astype(float), 0.4, start=(0.7, 0.8))
    prior, table = 0.4, [[[0.2, 0.8 * 0.7, 0.8 * 0.3], [0.2, 0.8 * 0.2, 0.8 * 0.8]] for _ in range(4)]

    def posterior(vote):
        mass = [1 - prior, prior]
        for v, x in enumerate(vote):
            if x:
                for c in (0, 1):
                    mass[c] *= table[v][c][x] / (table[v][c][1] + table[v][c][2])
        return mass[1] / sum(mass)

    for _ in range(60):
        q = [posterior(x) for x in votes.tolist()]
        for v in range(4):
            for c in (0, 1):
                n = [1.0, 1.0, 1.0]
                for x, p in zip(votes.tolist(), q, strict=True):
                    n[x[v]] += p if c else 1 - p
                table[v][c] = [y / sum(n) for y in n]
        prior = sum(q) / len(q)
    assert np.allclose(model.posterior(votes), [posterior(x) for x in votes.tolist()], atol=1e-8)


def test_linear_scores_equal_a_plain_sum(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghijklm") for _ in range(5)) for _ in range(300)]
    d = spark.createDataFrame([(k, prose(rnd, words, rnd.randint(0, 60))) for k in range(200)], "doc_id long, text string")
    model = quality.fit(d)
    for r in quality.score(d, model).limit(30).collect():
        text = d.filter(F.col("doc_id") == r.doc_id).first().text
        row, col, value = quality.features(quality.describe(pa.array([text])))
        z = model.bias + sum(model.weights[c] * v for c, v in zip(col.tolist(), value.tolist(), strict=True))
        assert abs(r.score - (1 / (1 + np.exp(-z)) if text.split() else 0.0)) < 1e-9


def test_unspaced_scripts_and_repeated_rows_are_kept(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(2, 8))) for _ in range(2000)]
    rows = [(k, prose(rnd, words, 80)) for k in range(300)] + [(300 + k, "@@@ ### " * 40) for k in range(40)]
    chinese = ["".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(200)) + "。" for _ in range(20)]
    rows += [(1000 + k, t) for k, t in enumerate(chinese)] + [(1000, chinese[0]), (2000, "donaudampfschifffahrtsgesellschaft " * 3)]
    got = quality.keep_good(spark.createDataFrame(rows, "doc_id long, text string"), quality.fit(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    kept = [r.doc_id for r in got]
    assert sum(k >= 1000 for k in kept) >= 21 and kept.count(1000) == 2 and not any(300 <= k < 340 for k in kept)


def test_long_texts_are_read_whole_in_pieces():
    """Statistics, votes and terms do not depend on where a text is cut."""
    rnd = random.Random(6)
    words = ["".join(rnd.choice("abcdefghijklmXYZ.!#0") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    text = " ".join(rnd.choice(words) for _ in range(3000)) + "\nidiot"
    whole, whole_terms = quality.describe(pa.array([text, text[:500]])), toxicity.Terms(np.sort(toxicity.hash_words(tuple(w.lower() for w in set(words) if w.isalpha()))), np.zeros(1000, np.int64), np.ones(1000))
    read = toxicity.Reading(pa.array([text]), whole_terms, votes=True)
    from foliospark.llm import common

    before = common.CHUNK_BYTES
    try:
        common.CHUNK_BYTES = 200
        common.text_chunks.__defaults__ = (200,)
        cut = quality.describe(pa.array([text, text[:500]]))
        again = toxicity.Reading(pa.array([text]), whole_terms, votes=True)
    finally:
        common.CHUNK_BYTES = before
        common.text_chunks.__defaults__ = (before,)
    assert all(np.allclose(whole.values[k], cut.values[k]) for k in whole.values) and (whole.shapes == cut.shapes).all()
    assert (read.term == again.term).all() and all((getattr(read, k) == getattr(again, k)).all() for k in ("n_words", "listed", "upper", "marks"))


def test_memory_of_one_long_text():
    """A text of 20 MB costs a worker less than 300 MB in the numpy operators."""
    import subprocess
    import sys

    code = """
import random, resource, sys
import pyarrow as pa, numpy as np
from foliospark.llm import quality, ngram_join, toxicity, decontamination, common
rnd = random.Random(1)
words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(2, 9))) for _ in range(5000)]
texts = pa.array([" ".join(rnd.choices(words, k=3_000_000))[:20_000_000]])
terms = toxicity.Terms(np.sort(toxicity.hash_words(tuple(words[:50]))), np.zeros(50, np.int64), np.ones(50))
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
low = peak()
for work in (lambda: ngram_join.Shingles(texts), lambda: quality.features(quality.describe(texts)), lambda: toxicity.Reading(texts, terms, True), lambda: [decontamination.Templates(p.words).windows(5) for p in common.word_pieces(texts, 4)]):
    work()
print(peak() - low)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout
    assert float(out) < 300
