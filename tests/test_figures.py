"""The whole way from word boxes to crops."""

from pyspark.sql import functions as F  # noqa: F401

from foliospark.operators import figures


def grid(page, caption, columns=((50, 250),), rows=range(80, 700, 14), gap=(200, 400)):
    """Words on lines, a gap for the figure, a caption line."""
    out = []
    for y in rows:
        if gap[0] < y < gap[1]:
            continue
        for left, right in columns:
            out += [(page, float(x), float(y), float(x + 20), float(y + 10), "w") for x in range(left, right, 25)]
    left = columns[0][0]
    out += [(page, float(left), caption, left + 30.0, caption + 10, "Figure"), (page, left + 32.0, caption, left + 40.0, caption + 10, "2:")]
    return out


def tables(spark, words, images=()):
    rows = [("p", page, k, *rest) for k, (page, *rest) in enumerate(words)]
    w = spark.createDataFrame(rows, "pdf string, page int, seq int, x_min double, y_min double, x_max double, y_max double, text string")
    pages = spark.createDataFrame([("p", 1, 612.0, 792.0, "intro, see Figure 2 there"), ("p", 2, 612.0, 792.0, "x\n  Figure 2: a plot")], "pdf string, page int, width double, height double, text string")
    i = spark.createDataFrame([("p", *x) for x in images], "pdf string, page int, type string, width int, height int")
    return pages, w, i


def test_one_column_with_the_figure_above_its_caption(spark):
    pages, words, images = tables(spark, grid(2, 406.0), [(2, "image", 700, 400), (2, "smask", 900, 900)])
    asks = spark.createDataFrame([("p", "Figure 2", None), ("p", "Figure 9", None), ("p", "no number", None)], "pdf string, label string, page_hint int")
    got = figures.derive_crops(asks, pages, words, images).collect()
    assert len(got) == 1 and got[0].page == 2 and got[0].tier == "embedded"
    box = got[0].box
    assert box.y_min == 192 + 12 and (box.x_min, box.x_max) == (0, 612)
    assert got[0].pixels.w == 1275


def test_two_columns_and_a_hint(spark):
    pages, words, images = tables(spark, grid(2, 406.0, ((50, 250), (340, 560))))
    asks = spark.createDataFrame([("p", "Fig. 2", 2), ("p", "Fig. 2", 7)], "pdf string, label string, page_hint int")
    got = figures.derive_crops(asks, pages, words, images).collect()
    assert len(got) == 1 and got[0].tier == "vector"
    box = got[0].box
    assert (box.y_min, box.y_max) == (60, 402) and box.x_min == 44 and 240 < box.x_max < 290


def test_a_caption_must_be_found(spark):
    pages, words, images = tables(spark, [w for w in grid(2, 406.0) if w[-1] == "w"])
    asks = spark.createDataFrame([("p", "Figure 2", 2)], "pdf string, label string, page_hint int")
    assert figures.derive_crops(asks, pages, words, images).collect() == []
