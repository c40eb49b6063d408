"""Golden cases of the column functions."""

import json

import pytest
from pyspark.sql import functions as F

from foliospark.functions import jsonx as J
from foliospark.functions import text as T


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"`{k}` {'string' if v is None or isinstance(v, str) else 'double' if isinstance(v, float) else 'bigint'}" for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("html", "stripped", "plain"),
    [
        ("a<b>c</b>", "a c", "ac"),
        ("a<b>c</b>&amp;lt;", "a c <", "ac<"),
        ("<script>x<y</script> <style a='b'>p{}</style>t<!-- c -->\n\n u", "t u", None),
        ("&nbsp;&quot;q&#39; &gt;", "\"q' >", "\"q' >"),
        ("", "", ""),
    ],
)
def test_html(spark, html, stripped, plain):
    assert one(spark, T.strip_html(F.col("h")), h=html) == stripped
    if plain is not None:
        assert one(spark, T.html_to_plain(F.col("h")), h=html) == plain


def test_identifiers(spark):
    assert one(spark, T.pdf_custom_id(F.col("n")), n="My Paper (1).PDF") == "explainer-My-Paper--1-"
    assert len(one(spark, T.pdf_custom_id(F.col("n")), n="x" * 100 + ".pdf")) == 64
    assert len(one(spark, T.url_custom_id(F.col("u")), u="https://a.org/" + "y" * 200)) == 94
    assert one(spark, T.lane_base(F.col("i")), i="explainer-a::lane::results") == "explainer-a"
    assert one(spark, T.lane_name(F.col("i")), i="explainer-a::lane::results") == "results"
    assert one(spark, T.figure_token(F.col("i")), i="Fig. 3.0b x") == "3.0b"


@pytest.mark.parametrize(("url", "want"), [("http://a/b.PDF?x", True), ("http://a/b?x=.pdf", False), ("https://arxiv.org/pdf/1", True), ("https://arxiv.org/abs/1", False)])
def test_pdf_urls(spark, url, want):
    assert one(spark, T.is_pdf_url(F.col("u")), u=url) is want


def test_round4_is_half_up_of_the_binary_value(spark):
    assert one(spark, T.round4(F.col("v")), v=0.0038499999999999997) == 0.0039
    assert one(spark, T.usd(F.col("v")), v=1.5) == "$1.5000"


def test_positive_int(spark):
    for text, want in (("7.9", 7), ("-3", 5), ("many", 5), (None, 5), ("0", 5)):
        assert one(spark, T.positive_int(F.col("t"), F.lit(5)), t=text) == want


def test_frontmatter(spark):
    for text, want in (("---\na: b\n---\n\nbody\n", "body\n"), ("---\nopen", "---\nopen"), ("body", "body"), ("---\n---", "")):
        assert one(spark, T.strip_frontmatter(F.col("t")), t=text) == want


def test_page_density(spark):
    prose = "\n".join(["one two three four five six seven"] * 30)
    code = "\n".join(["x = 1"] * 7)
    for text, want in ((prose, True), (code, False), (code + "\nx = 1", True), ("", False)):
        assert one(spark, T.is_code_or_prose(F.col("t")), t=text) is want


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ('```json\n{"a": 1}\n``` and }', {"a": 1}),
        ('Here: {"a": {"b": 2}} done', {"a": {"b": 2}}),
        ('{"a":1} foo {"b":2}', None),
        ("```json\n{bad}\n```", None),
        ("", None),
        ('{"a": 1', None),
        ("[1, 2]", [1, 2]),
    ],
)
def test_extract_json(spark, raw, want):
    got = one(spark, F.to_json(J.extract_json(F.col("r"))), r=raw)
    assert (json.loads(got) if got else None) == want


def test_falsy_and_blank(spark):
    record = json.dumps({"a": "", "b": 0, "c": False, "d": None, "e": "0", "f": [], "g": " ", "h": 0.0})
    falsy = {k: one(spark, J.falsy(J.get(F.parse_json("r"), k)), r=record) for k in "abcdefghz"}
    assert falsy == dict.fromkeys("abcdhz", True) | dict.fromkeys("efg", False)
    assert one(spark, J.blank(J.get(F.parse_json("r"), "g")), r=record) is True
    assert one(spark, J.blank(J.get(F.parse_json("r"), "e")), r=record) is False
