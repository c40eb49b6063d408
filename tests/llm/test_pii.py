import collections
import hashlib
import math
import random
import re

from foliospark.llm import pii
from foliospark.llm.pii import disclosures, find, revealing_terms, sanitise

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(v):
    d = [int(c) for c in v if c.isdigit()]
    return 14 <= len(d) <= 19 and sum((x * 2 - 9 if x > 4 else x * 2) if k % 2 else x for k, x in enumerate(d[::-1])) % 10 == 0


VALID = {"email": lambda v: True, "ip": lambda v: all(float(x) <= 255 for x in v.split(".")), "card": luhn, "phone": lambda v: 10 <= sum(c.isdigit() for c in v) <= 15}


def brute(text):
    spans = sorted((m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if VALID[kind](m[0]))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


def test_base_spans_equal_plain_regexes(spark):
    rnd = random.Random(5)
    texts = ["a@b.c-d%x@e.f", "1.2.3.4.5.6.7.8 300.1.1.1", "+1 (988) 555-2485, 4041894974608795", "", "😀 4041 8949 7460 8795 +44 20 1234 5678", "@" * 50, "1" * 3000, "1.1.1." * 50]
    texts += ["".join(rnd.choice("ab@.1234 -+()%é") for _ in range(rnd.randint(1, 60))) for _ in range(1500)]
    texts += ["".join(rnd.choice("0123 .-+") for _ in range(rnd.randint(10, 80))) for _ in range(1500)]
    rows = list(enumerate(texts)) + [(10**6, None), (10**6 + 1, "9" * 100_000 + "a" * 100_000)]
    got = find(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as _base", "2 as spans")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(rows[r.doc_id][1]) if r.doc_id < 10**6 else ""
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_revealing_terms_but_not_copies(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(3000)]
    some = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    rows = [(k, some(50)) for k in range(200)]
    rows += [(k, f"{some(20)} Zebulon {some(2)} boss@corp.example {some(25)}") for k in range(200, 206)]
    rows += [(206, f"{some(10)} zebulon, {some(10)}")]
    before, after = some(10), some(10)
    rows += [(k, f"{before} x@y.example {after} {some(1)}") for k in range(207, 230)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.term for r in revealing_terms(docs).collect()] == ["zebulon"]
    found = {r.doc_id: r for r in find(docs).collect()}
    assert {k for k, r in found.items() if r.n_term} == set(range(200, 207))
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert "boss@" not in clean[200] and "[EMAIL]" in clean[200] and "ebulon" not in clean[200] + clean[206]
    assert clean[0] == rows[0][1]


def test_more_evidence_hides_no_term(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(300)]
    some = lambda n: [rnd.choice(words) for _ in range(n)]
    text = lambda before, mail, after: " ".join([*before, "Zebulon", mail, *after])
    frequent = [(k, text(some(8), "boss@corp.example", some(8))) for k in range(400)]
    passage, copies = some(16), []
    for k in range(300):
        words_ = list(passage)
        words_[rnd.randrange(16)] = f"new{rnd.choice(words)}"
        copies.append((k, text(words_[:8], "boss@corp.example", words_[8:])))
    different = [(1000 + k, text(some(8), "boss@corp.example", some(8))) for k in range(6)]
    others = [(2000 + k, " ".join(some(60))) for k in range(2000)]
    terms = lambda rows: {r.term for r in revealing_terms(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert terms(frequent + others) == {"zebulon"}
    assert terms(copies + others) == set()
    assert terms(different + others) == terms(different + copies + others) == {"zebulon"}


def test_sanitise_keeps_columns_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a@b.cc x", 7), (2, None, 8), (2, "", 9), (None, "1.2.3.4", 10)], "doc_id long, text string, _t int")
    got = sanitise(docs)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text, r["_t"]) for r in got.collect() if r.text is not None) == [("1", "[EMAIL] x", 7), ("2", "", 9), ("None", "[IP]", 10)]
    assert sanitise(docs.limit(0)).collect() == [] and find(docs.limit(0)).collect() == []


def brute_disclosures(rows):
    """Disclosure of every supported term, by loops over units."""
    general = {"email": lambda v: v.split("@")[-1], "ip": lambda v: v.rsplit(".", 1)[0], "phone": lambda v: re.sub(r"\D", "", v)[:4], "card": lambda v: re.sub(r"\D", "", v)[:6]}

    def protected(text):
        found = {(kind, m[0].lower()) for kind, p in PATTERNS.items() for m in re.finditer(p, text) if VALID[kind](m[0])}
        return {("value", *x) for x in found} | {("class", k, general[k](v)) for k, v in found}

    def cut(text):
        words = re.findall(r"\S+", text)
        return [" ".join(words[k : k + pii.UNIT_WORDS]) for k in range(0, len(words), pii.UNIT_WORDS)]

    def terms(text):
        return [w for w in re.findall(r"\w+", re.sub(PATTERNS["email"], " ", text).lower()) if w.isalpha() and len(w) >= 4]

    rows_of = collections.Counter(e for _, t in rows for e in protected(t))
    units = [(protected(u), terms(u)) for _, t in rows for u in cut(t)]
    n, n_t = max(len(units), 2), collections.Counter(w for _, ws in units for w in set(ws))
    best = {}
    for e in (e for e, c in rows_of.items() if c >= 3):
        mine = [ws for es, ws in units if e in es]
        grams = [{tuple(ws[k : k + 3]) for k in range(max(len(ws) - 2, 1))} for ws in mine]
        m = collections.Counter(g for gs in grams for g in gs)
        weight = [1 / sorted(m[g] for g in gs)[(len(gs) - 1) // 2] for gs in grams]
        for t in {w for ws in mine for w in ws}:
            spots = {(ws[k - 1] if k else None, ws[k + 1] if k + 1 < len(ws) else None) for ws in mine for k, w in enumerate(ws) if w == t}
            n_te = sum(t in ws for ws in mine)
            if n_te >= 3 and len(spots) >= 3 and sum(w for w, ws in zip(weight, mine, strict=True) if t in ws) >= 3 - 1e-9:
                p_e = len(mine) / n
                best[t] = max(best.get(t, -99), math.log((n_te / n) / (n_t[t] / n * p_e)) / -math.log(p_e))
    return best


def test_disclosures_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pii, "UNIT_WORDS", 12)
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 6))) for _ in range(40)]
    rows = []
    for k in range(150):
        text = [rnd.choice(words) for _ in range(rnd.randint(0, 40))]
        for _ in range(rnd.choice([0, 0, 1, 2])):
            text.insert(rnd.randrange(len(text) + 1), rnd.choice(["boss@corp.example", "me@corp.example", "10.0.0.1", "10.0.0.7", "+44-20-1234-5678", "4041894974608795"]))
        rows.append((k % 140, " ".join(text)))
    rows += rows[:20]
    want = brute_disclosures(rows)
    got = {r.term: r.disclosure for r in disclosures(spark.createDataFrame(rows, "doc_id long, text string"), least=-99.0).collect()}
    assert len(want) > 20 and got.keys() == want.keys()
    assert all(abs(got[t] - want[t]) < 1e-9 for t in want)
    some = {r.term for r in disclosures(spark.createDataFrame(rows, "doc_id long, text string"), least=0.1).collect()}
    assert some == {t for t, x in want.items() if x >= 0.1} and 0 < len(some) < len(want)


def test_terms_are_generalised_where_that_hides_enough(spark):
    rnd = random.Random(11)
    some = lambda n: " ".join("".join(rnd.choice("abcdefghijklnop") for _ in range(7)) for _ in range(n))
    rows = [(k, f"{some(20)} Martinson {some(2)} boss@corp.example {some(5)}") for k in range(8)]
    rows += [(100 + k, f"{some(10)} {rnd.choice(['marten', 'martial', 'martyr'])} {some(10)}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [(r.term, r.shown) for r in revealing_terms(docs).collect()] == [("martinson", "mart*")]
    assert " mart* " in {r.doc_id: r.text for r in sanitise(docs).collect()}[3]


def test_many_matches_and_marks(spark):
    text = "a@b.cc \x01 1.2.3.4, " * 3000
    rows = [(1, text), (2, "\x01a@b.cc\x01"), (3, "\x01")]
    got = {r.doc_id: r for r in find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].spans == brute(text) and got[2].spans == "email:1:7" and got[3].spans == ""
    assert sanitise(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id = 1").first().text == "[EMAIL] \x01 [IP], " * 3000
