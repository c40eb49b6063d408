import corpus_pipeline


def test_stages_on_a_small_corpus(spark, tmp_path):
    import random

    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(2, 8))) for _ in range(2000)]
    prose = lambda n: " ".join(rnd.choice(words) + rnd.choice(["", "", "", "."]) for _ in range(n))
    item = prose(30)
    rows = [(k, prose(80), "en", f"src{k % 5}") for k in range(300)]
    rows += [(1000 + k, rows[k][1], "en", "src1") for k in range(20)]  # copies
    rows += [(2000 + k, "@@@ ### " * 40, "en", "src2") for k in range(40)]  # junk
    rows += [(3000, f"{prose(20)}. {item} {prose(20)}", "en", "src3")]  # a leak
    rows += [(4000, f"{prose(40)} mail me@corp.example {prose(40)}", "en", "src4"), (5000, None, None, None)]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    state, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        state = stage(spark, state, str(tmp_path))
        state.write.parquet(f"{tmp_path}/{name}")
        state = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in state.collect()}
        if name != "mixing":
            assert state.columns == docs.columns
    assert set(seen["quality_classifier"]) == {r[0] for r in rows if r[0] < 2000 or 3000 <= r[0] < 5000}
    assert set(seen["ngram_jaccard_join"]) == set(range(300)) | {3000, 4000}
    assert set(seen["benchmark_decontamination"]) == set(range(300)) | {4000}
    clean = seen["pii"]
    assert "[EMAIL]" in clean[4000].text and clean[4000].n_chars == len(clean[4000].text) and clean[7].text == rows[7][1]
    assert seen["mixing"] and set(seen["mixing"]) <= set(clean)
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(seen["mixing"])


def test_odd_rows_and_extra_columns(spark, tmp_path):
    import random

    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(2, 8))) for _ in range(2000)]
    prose = lambda n: " ".join(rnd.choice(words) + rnd.choice(["", "", "", "."]) for _ in range(n))
    rows = [(k, prose(60), "en", f"src{k % 4}") for k in range(120)]
    rows += [(1, rows[1][1], "en", "src1"), (None, prose(50), None, None), (None, rows[5][1], "en", "src1"), (500, None, "en", None), (501, "", None, "src1"), (502, prose(120_000), "en", "src2")]
    docs = spark.createDataFrame([(*r, len(r[1] or ""), "x", 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, _key string, n int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = [r.doc_id for r in got]
    assert set(ids) <= {*range(120), None, 502} and ids.count(None) <= 1 and len(ids) > 40 and all(r._key == "x" and r.n == 7 for r in got)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
