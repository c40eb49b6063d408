import hashlib
import random

from foliospark.llm import edit_fingerprint as E
from foliospark.llm.edit_fingerprint import compare_with_edited, fingerprint, fingerprints, likeness, near_copies


def texts(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefghij klmno\n") for _ in range(rnd.choice([1, 5, 80, 900, 4000]))) for _ in range(n)]


def test_small_edits_stay_near_and_others_do_not():
    a, b = texts(2, 7)
    a, b = (a * 4000)[:3000], (b * 4000)[:3000]
    for edited in ("X" + a, a[:900] + "yy" + a[900:], a[:2000] + a[2003:]):
        assert likeness(*fingerprints([a, edited])) > 0.7
    assert likeness(*fingerprints([a, a])) == 1 and likeness(*fingerprints([a, b])) < 0.4
    assert fingerprints(["", a])[0] == "" and likeness("", "") == 1 and likeness("", "ab") == 0


def test_result_does_not_depend_on_company():
    some = texts(40)
    assert fingerprints(some) == [fingerprints([t])[0] for t in some]


def test_edited_texts_and_successors(spark):
    rows = [(k * 3 + 1, t) for k, t in enumerate(texts(300, 3))] + [(2, None), (5, ""), (10**12, "z" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as bucket", "2 as ahead").repartition(3)
    got = {r.doc_id: r for r in compare_with_edited(docs).collect()}
    order = sorted((k, t or "") for k, t in rows)
    assert len(got) == len(rows)
    for (k, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + nxt[:cut]
        assert got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[k].n_chars == len(t)
    own = dict(zip([k for k, _ in order], fingerprints([t for _, t in order])))
    assert all(got[k].fingerprint == own[k] for k in own)


def test_repeated_null_and_single_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    assert len(compare_with_edited(docs).collect()) == 3
    assert compare_with_edited(docs.filter("doc_id is null")).first().near_next == 1
    assert compare_with_edited(docs.limit(0)).collect() == []


def test_near_copies_by_bands(spark):
    base = [t for t in texts(60, 5) if len(t) > 500]
    rows = [(k, t) for k, t in enumerate(base)] + [(1000 + k, t[:-20] + "?" * 20) for k, t in enumerate(base)] + [(5000, ""), (5001, base[0])]
    got = {r.doc_id: r.class_id for r in near_copies(fingerprint(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert all(got[k] == got[1000 + k] == k for k in range(len(base))) and got[5001] == 0 and got[5000] == 5000


def test_near_copies_without_a_common_first(spark, monkeypatch):
    monkeypatch.setattr("foliospark.llm.edit_fingerprint.BLOCK", 2)
    rnd = random.Random(11)
    made = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    # all share the last band only; the first (1) is like none, 2 and 3 are alike
    last, own = made(8), made(64)
    other = "".join("z" if k % 8 == 0 else c for k, c in enumerate(own))  # one change in every other band
    rows = [(1, made(64) + last), (2, own + last), (3, other + last), *((10 + k, made(64) + last) for k in range(7))]
    got = {r.doc_id: r.class_id for r in near_copies(spark.createDataFrame(rows, "doc_id long, fingerprint string")).collect()}
    assert likeness(rows[1][1], rows[2][1]) >= 0.8 > likeness(rows[0][1], rows[1][1])
    assert got == {k: (2 if k == 3 else k) for k, _ in rows}


def plain_walk(text):
    out, at, j, steps = "", 0, 0, set(E.STEPS[:2000].tolist())
    while at < len(text):
        code = max((ord(text[at] if text[at] != "\0" else " ") * 2654435761 % 2**32) >> 24, 1)
        if j in steps:
            out += "0123456789abcdef"[E._NIBBLE[code]]
        at += int(E._MOVES[j % E.PERIOD, code])
        j += 1
    return out


def test_fingerprints_equal_a_plain_walk(monkeypatch):
    monkeypatch.setattr(E, "SLICE", 7)
    some = [*texts(25, 8), "", "é😀 x\0y" * 30, "a" * 20]
    assert fingerprints(some) == [plain_walk(t) for t in some]


def test_near_copies_against_all_pairs(spark):
    rnd = random.Random(12)
    rows = []
    for base in [t for t in texts(150, 13) if len(t) > 60]:
        rows.append(base)
        for _ in range(rnd.choice([0, 1, 3])):
            copy = list(base)
            for _ in range(rnd.choice([1, 3, len(base) // 40, len(base) // 12])):
                copy[rnd.randrange(len(copy))] = rnd.choice("QRSTUVW")
            rows.append("".join(copy) + rnd.choice(["", "", " and more" * rnd.randint(1, 9)]))
    prints = fingerprints(rows)
    alike = [(a, b) for a in range(len(rows)) for b in range(a) if likeness(prints[a], prints[b]) >= 0.8]
    got = {r.doc_id: r.class_id for r in near_copies(spark.createDataFrame(list(enumerate(prints)), "doc_id long, fingerprint string")).collect()}
    assert len(alike) > 40 and sum(got[a] == got[b] for a, b in alike) >= 0.9 * len(alike)
    # no class holds more than links join
    parent = list(range(len(rows)))
    for a, b in alike:
        x, y = a, b
        while parent[x] != x:
            x = parent[x]
        while parent[y] != y:
            y = parent[y]
        parent[max(x, y)] = min(x, y)

    def top(x):
        return x if parent[x] == x else top(parent[x])

    assert all(top(k) == top(c) for k, c in got.items())
