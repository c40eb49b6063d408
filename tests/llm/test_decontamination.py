from foliospark.llm.decontamination import UNITS, drop_leaks, find_leaks

ITEM = "so Tom has 3 apples and buys 5 kg of pears for 7 dollars from Ann today"


def test_leaks_by_kind(spark):
    rows = [
        (1, "Before. " + ITEM + " After."),
        (2, "Well, so Jim has 9 apples and buys 4 km of pears for 2 dollars from Sue today ok"),
        (3, "apples and pears are sold by the kg for dollars"),
        (4, None),
        (5, ""),
        (1, "the same id again"),
        (6, "word " * 50000 + ITEM),
        (None, ITEM),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as w", "'x' as item_id")
    items = spark.createDataFrame([(7, ITEM), (8, None), (9, "a b"), (10, "one two three")], "item_id long, text string")
    got = {r.doc_id: (r.item_id, r.kind) for r in find_leaks(docs, items).collect()}
    assert got == {1: (7, "verbatim"), 2: (7, "reparameterised"), 6: (7, "verbatim"), None: (7, "verbatim")}
    kept = drop_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "5"]


def test_capitals_hide_nothing(spark):
    item = "the quick brown fox jumps over one lazy dog near two old stone bridges today"
    rows = [(1, "so it says: " + item.title() + " he said"), (2, "AND " + item.upper()), (3, "Yes " + item.replace("fox", "Fox") + "."), (4, "the quick brown cat sleeps under one lazy dog far from all bridges")]
    got = find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r.doc_id for r in got.collect()} == {1, 2, 3}


def test_contradicting_slots_are_no_leak(spark):
    docs = spark.createDataFrame([(1, "add 4 to 9 then 4 to 9 and 4 to 9 more")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "add 2 to 3 then 4 to 2 and 2 to 4 more")], "item_id long, text string")
    assert find_leaks(docs, items).collect() == []


def test_one_agreeing_place_is_enough(spark):
    other = "so Jim has 9 apples and buys 4 km of pears for 2 dollars from Sue today"
    third = "so Bob has 8 apples and buys 6 lb of pears for 1 dollars from Eve today"
    rows = [
        (1, f"Before. {ITEM} and {other} ok"),
        (2, f"Well, {other} or {third} ok"),
        (3, f"Well, {other} ok. " + "word " * 300 + "sold 12 kg of pears for 5 of them"),
        (4, "Well, " + other.replace("and buys", "and then really buys") + f" or {third[:30]} ok"),
        (5, "sold 12 kg of pears for 5 of them and 6 kg of pears for 4 of them"),
    ]
    got = find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(7, ITEM)], "item_id long, text string"))
    assert {r.doc_id: r.kind for r in got.collect()} == {1: "verbatim", 2: "reparameterised", 3: "reparameterised", 4: "reparameterised"}


def test_equals_substring_search(spark):
    import random

    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcde") for _ in range(4)) for _ in range(300)]
    some = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    items = [(k, some(rnd.randint(6, 40))) for k in range(30)]
    docs = []
    for k in range(300):
        leak = rnd.choice(items)[1] if k % 5 == 0 else ""
        docs.append((k, f"{some(rnd.randint(5, 80))}. {leak} {some(20)}"))
    want = {(i, j) for i, t in docs for j, b in items if b in t}
    got = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(docs, items).collect() == [] and find_leaks(docs.limit(0), items).collect() == []


def test_numbers_alone_and_long_words(spark):
    numbers = "1 2 3 5 8 13 21 34 55 89"
    item = "the giant said " + "x" * 300_000 + " and then he left the hall in a hurry"
    rows = [(1, "see 7 " + numbers + " 144"), (2, "1 2 3 5 9 13 22 34 56 89"), (3, "word " * 90_000 + item.upper()), (4, item.replace("xxx", "y", 1))]
    got = find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, numbers), (2, item)], "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id): r.coverage for r in got}
    assert found[(1, 1)] == 1.0 and found[(3, 2)] == 1.0 and {x for x, _ in found} == {1, 3, 4}


def plain_windows(text):
    """(position, key, slots) of every window, by a loop over words."""
    words, n = text.split(), 5
    kinds, lower = [], []
    for k, w in enumerate(words):
        bare = w
        for _ in range(4):
            bare = bare[:-1] if len(bare) > 1 and bare[-1] in ".,;:!?\"'()[]{}<>*_~`" else bare
            bare = bare[1:] if len(bare) > 1 and bare[0] in ".,;:!?\"'()[]{}<>*_~`" else bare
        lower.append(bare.lower())
        if any(c.isdigit() for c in bare) and (all(c in "0123456789.,:/%$+-" for c in bare) or bare[0].isdigit()):
            kinds.append(1)
        elif k and kinds[-1] == 1 and bare.lower() in UNITS:
            kinds.append(2)
        else:
            kinds.append(3 if k and bare[0].isupper() and words[k - 1][-1] not in ".!?:;" else 0)
    out = []
    for at in range(len(words) - n + 1):
        own = list(zip(kinds[at : at + n], lower[at : at + n], strict=True))
        literals, names = sum(k == 0 for k, _ in own), sum(k == 3 for k, _ in own)
        for shown, use in (((1, 2, 3), literals >= 3), ((1, 2), names > 0 and literals + names >= 3)):
            if use:
                out.append((at, tuple(f"<{k}>" if k in shown else w for k, w in own), tuple((k, w) for k, w in own if k in shown)))
        if literals + names < 3:
            out.append((at, ("exact", *(w for _, w in own)), ()))
    return out


def plain_leak(doc, item):
    windows = plain_windows(item)
    hits = [(a, p, sa, sb) for a, ka, sa in windows for p, kb, sb in plain_windows(doc) if ka == kb]
    places = {}
    for a, p, sa, sb in hits:
        shift = p - a
        for place in ("whole", (1, shift), *((w, half, (shift + half * (w // 2)) // w) for w in (8, 64) for half in (0, 1))):
            places.setdefault(place, []).append((a, sa, sb))
    best = (0, "")
    for found in places.values():
        fills = {(x, y) for _, sa, sb in found for x, y in zip(sa, sb, strict=True)}
        if all(x == y for x, y in fills):
            best = max(best, (len({a for a, _, _ in found}), "verbatim"))
        elif len({x for x, _ in fills}) == len(fills):
            best = max(best, (len({a for a, _, _ in found}), "reparameterised"))
        else:
            best = max(best, (len({a for a, sa, sb in found if sa == sb}), "partial"))
    total = len({a for a, _, _ in windows})
    return (best[1], best[0]) if total and best[0] / total >= 0.5 else None


def test_equals_plain_search_with_slots(spark):
    import random

    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcde") for _ in range(4)) for _ in range(60)]

    def some(n):
        return [rnd.choice([rnd.choice(words)] * 6 + [str(rnd.randint(1, 40)), f"{rnd.randint(1, 9)} {rnd.choice(('kg', 'km', 'miles'))}", rnd.choice(("Tom", "Ann", "Sue"))]) for _ in range(n)]

    items = [(k, " ".join(some(rnd.randint(6, 25)))) for k in range(12)]
    docs = []
    for k in range(80):
        leak = rnd.choice(items)[1].split()
        if k % 4 == 0:  # one consistent substitution
            leak = [{"Tom": "Bob", "Ann": "Eve"}.get(w, str(int(w) + 100) if w.isdigit() else w) for w in leak]
        elif k % 4 == 1:  # contradicting ones
            leak = [str(rnd.randint(1, 99)) if w.isdigit() else w for w in leak]
        elif k % 4 == 2:
            leak = leak[: rnd.randint(1, len(leak))] + some(3) + leak[rnd.randint(0, len(leak)) :]
        docs.append((k, " ".join(some(rnd.randint(0, 30)) + leak + some(8))))
    want = {(i, j): x for i, t in docs for j, b in items if (x := plain_leak(t, b))}
    got = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): (r.kind, r.n_windows) for r in got.collect()} == want
    assert {k for k, _ in want.values()} >= {"verbatim", "reparameterised"}
