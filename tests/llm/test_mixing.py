from pyspark.sql import functions as F

from foliospark.llm.mixing import allocate, plan_copies, select_rows


def leaves(spark, rows):
    return spark.createDataFrame(rows, "domain string, language string, origin string, tokens long")


def test_shortage_goes_to_siblings_before_ancestors(spark):
    rows = [("a", "x", "1", 10), ("a", "x", "2", 1000), ("a", "y", "3", 1000), ("b", "x", "4", 1000)]
    got = {r.origin: r.alloc for r in allocate(leaves(spark, rows), {}, 200, 1).collect()}
    # 602 tokens: 301 a domain; language x of a gets 150, of which source 1 has 10
    assert got == {"1": 10, "2": 140, "3": 150, "4": 301}


def test_a_short_subtree_passes_on(spark):
    rows = [("a", "x", "1", 10), ("a", "y", "2", 20), ("b", "x", "3", 1000), ("b", "x", "4", 1000)]
    got = {r.origin: r.alloc for r in allocate(leaves(spark, rows), {"origin": {"4": 3}}, 500, 1).collect()}
    assert got["1"] == 10 and got["2"] == 20 and got["3"] + got["4"] in (984, 985) and abs(got["4"] - 3 * got["3"]) <= 3


def test_epochs_and_prefix(spark):
    rows = [(k, "w " * (k % 7 + 1), "en", "s1") for k in range(200)] + [(900, None, "en", "s1"), (901, "", None, None), (902, "one two", None, None), (902, "one two", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for parts, epochs in ((300, 1), (1500, 3), (9000, 3)):
        plan = plan_copies(docs, {}, budget_parts=parts, max_epochs=epochs)
        got = plan.collect()
        assert len(got) == len(rows)
        chosen = sum(r.n_tokens * r.n_copies for r in got)
        total = sum(r.n_tokens for r in got)
        assert chosen <= min(total * parts // 1000, total * epochs) and chosen > 0.8 * min(total * parts // 1000, total * epochs)
        copies = {r.n_copies for r in got if r.n_tokens and r.origin == "s1"}
        assert max(copies) - min(copies) <= 1
    again = plan_copies(docs, {}, budget_parts=300, max_epochs=1)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, plan_copies(docs.repartition(3), {}, budget_parts=300, max_epochs=1).collect()), key=str)


def test_ranges_give_the_same_prefix_as_one_sort(spark):
    import hashlib

    rows = [(k, "w " * (k % 5 + 1), "en", "s1") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id for r in plan_copies(docs, {}, budget_parts=400, max_epochs=1, seed=5).collect() if r.n_copies}
    order = sorted((int(hashlib.md5(f"5:0:{k}".encode()).hexdigest()[:12], 16), k, k % 5 + 1) for k, *_ in rows)
    left, want = sum(n for *_, n in order) * 400 // 1000, set()
    for _, k, n in order:
        left -= n
        if left < 0:
            break
        want.add(k)
    assert got == want


def test_select_rows_keeps_columns_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s1", 9, 1)], "doc_id long, text string, lang string, source string, n_copies int, _key int")
    got = select_rows(docs, weights={}, budget_parts=2000, max_epochs=2)
    assert got.columns == ["doc_id", "text", "lang", "source", "_key", "n_copies"] and got.first().n_copies == 2
    assert select_rows(docs.limit(0)).collect() == []
    assert plan_copies(docs.withColumn("text", F.lit(None).cast("string"))).first().n_copies == 0
