import collections
import random
import re

import pytest

from foliospark.llm import ngram_join
from foliospark.llm.components import connected_components
from foliospark.llm.ngram_join import keep_one, link_documents


def brute(rows):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed):
    """Texts with copies, near copies of near copies, shared passages."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(800)]
    some = lambda n: [rnd.choice(words) for _ in range(n)]
    passage, out = some(60), []
    for _ in range(40):
        base = some(rnd.choice([3, 6, 30, 80, 150]))
        out.append(base)
        for _ in range(rnd.choice([0, 1, 6])):
            copy = list(out[-1] if rnd.random() < 0.5 else base)
            for _ in range(rnd.choice([0, 1, 2, 4])):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            out.append(copy)
    out += [passage + some(12) for _ in range(25)]
    out += [some(4), some(4), out[0], ["A"], ["a"]]
    rnd.shuffle(out)
    return [(k, " ".join(x).capitalize() if k % 3 else "\t".join(x)) for k, x in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed) + [(9000, None), (9001, ""), (9002, " \n ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as n", "3 as component_id")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link_documents(docs).collect()}
    assert got == brute(rows)


def test_beyond_the_broadcast_sizes(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_SHINGLES", 0)
    monkeypatch.setattr("foliospark.llm.common.BROADCAST_IDS", 0)
    monkeypatch.setattr(ngram_join, "FREQUENT", 1)
    rows = corpus(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_bitmaps_of_both_widths_agree(spark):
    from pyspark.sql import functions as F

    rows = [r for r in corpus(4) if len(r[1].split()) > 20][:40]
    docs = spark.createDataFrame(rows, "doc_id long, t string").select("doc_id", "t")
    small, wide = (ngram_join.bitmaps_of(docs, n).dropDuplicates(["sig"]) for n in (10**9, 0))
    both = small.select("sig", F.col("bits").alias("x")).join(wide.select("sig", F.col("bits").alias("y")), "sig")
    assert [r.d for r in both.select(ngram_join._apart(F.col("x"), F.col("y")).alias("d")).collect()] == [0] * both.count()
    assert both.filter("size(x) = 32 and size(y) = 512").count() == both.count() > 10


def test_odd_rows_and_keep_one(spark):
    text = "one two three four five six seven"
    rows = [(5, text), (3, text), (3, text), (7, "other words here"), (None, text), (8, "long " * 60000), (9, "long " * 60000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in link_documents(docs).collect())
    assert got == {(5, 3, 3): 1, (3, 3, 3): 2, (7, 1, 7): 1, (None, 3, None): 1, (8, 1, 8): 1, (9, 1, 8): 1}
    more = docs.unionAll(spark.createDataFrame([(None, "a text without an id"), (None, "a text without an id"), (None, ""), (None, None)], docs.schema))
    kept = keep_one(more.withColumn("_key", docs.doc_id)).drop("_key")
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect() if r.doc_id != 8) == [("3", text), ("3", text), ("7", "other words here"), ("None", ""), ("None", ""), ("None", "a text without an id")]
    assert link_documents(docs.limit(0)).collect() == []


def test_hot_shingles_and_torn_groups(spark, monkeypatch):
    """Many texts that share most words, none alike enough to the first."""
    monkeypatch.setattr(ngram_join, "LEAST_HOT", 3)
    monkeypatch.setattr(ngram_join, "HOT_KEYS", 10**9)
    monkeypatch.setattr(ngram_join, "BLOCK", 2)
    rnd = random.Random(6)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    frame, rows = [rnd.choice(words) for _ in range(60)], []
    for _ in range(60):
        cut = rnd.choice([6, 9, 12, 15])
        rows.append(frame[:-cut] + [rnd.choice(words[:8]) for _ in range(cut)])
    rows = [(k, " ".join(x)) for k, x in enumerate(rows)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and len({x for _, x in got.values()}) > 3


def test_bitmaps_of_ids_lose_none(spark, monkeypatch):
    from foliospark.llm import common

    monkeypatch.setattr(common, "BROADCAST_IDS", 0)
    rows = spark.range(-3000, 3000).withColumnRenamed("id", "k").unionAll(spark.createDataFrame([(None,)], "k long"))
    ids = spark.range(-3000, 3000, 7).withColumnRenamed("id", "k")
    want = set(range(-3000, 3000, 7))
    some = {r.k for r in common.may_hold(rows, ids, "k").collect()}
    assert want <= some and len(some) < 2 * len(want) and None not in some
    assert {r.k for r in common.without(rows, ids, "k").collect()} == set(range(-3000, 3000)) - want | {None}
    assert {r.k for r in common.join_ids(rows, ids, "k").collect()} == want
    assert common.may_hold(rows, ids.limit(0), "k").count() == 0 and common.without(rows, ids.limit(0), "k").count() == 6001


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(200, 200), (300, 299)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 160)} | {299: 299, 300: 299}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
