"""Figure geometry over word boxes: rows, gaps, columns, crops, density."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.text import figure_token, is_code_or_prose

#: Fixed values, in points, words and shares.
ROW_STEP, CAPTION_MARGIN, LINE_HEIGHT, LEAST_GAP = 3, 8, 12, 25
ROWS_BEFORE_BOTTOM = 5
BIN, RADIUS, LEAST_GUTTER = 6, 80, 30
LEAST_WORDS, LEAST_SIDE = 40, 20
LOW_SHARE = 0.2
HEADER_SKIP, CAPTION_GAP, BLEED = 60, 4, 6
DPI = 150
MOSTLY_TEXT = 0.30
EMBEDDED_WIDTH, EMBEDDED_HEIGHT = 600, 300


def sorted_join(df: DataFrame) -> DataFrame:
    """``df`` for a join that must sort both sides. Both grow with the input, and
    Spark takes the size of a table for that of its compressed files, so it would
    send tables of many times its bound to the driver and broadcast them."""
    return df.hint("merge")


def bucket_rows(ys: Column) -> Column:
    """Row positions: a value is kept if it lies beyond the last kept one."""
    start = F.array().cast("array<double>")
    keep = lambda rows, y: F.when((F.size(rows) == 0) | (y - F.element_at(rows, -1) > ROW_STEP), F.concat(rows, F.array(y))).otherwise(rows)
    return F.aggregate(F.array_sort(ys), start, keep)


def gap_above(rows: Column, caption: Column) -> Column:
    """Top of a figure above its caption, from the rows above it."""
    n = F.size(rows)
    last = F.get(rows, n - 1)
    steps = F.when(n >= 2, F.transform(F.sequence(F.lit(1), n - 1), lambda k: F.get(rows, k) - F.get(rows, k - 1))).otherwise(F.array().cast("array<double>"))
    best = F.coalesce(F.array_max(steps), F.lit(0.0))
    at = F.get(rows, (F.array_position(steps, best) - 1).cast("int"))
    tail = caption - CAPTION_MARGIN - last
    return F.when(n == 0, 0.0).when(tail > best, F.greatest(F.lit(0.0), last + LINE_HEIGHT)).when(best >= LEAST_GAP, F.least(caption, at + LINE_HEIGHT))


def gap_below(rows: Column, caption: Column, page_height: Column) -> Column:
    """Bottom of a figure below its caption, from the rows below it."""
    n = F.size(rows)
    first = ROWS_BEFORE_BOTTOM
    ends = F.when(n > first, F.filter(F.sequence(F.lit(first), n - 1), lambda k: F.get(rows, k) - F.get(rows, k - 1) >= LEAST_GAP)).otherwise(F.array().cast("array<int>"))
    return F.when(n == 0, page_height).when(F.size(ends) > 0, F.greatest(caption, F.get(rows, F.get(ends, F.lit(0))) - LINE_HEIGHT))


def column_bins(words: DataFrame, keys: list[str], centre: Column, width: Column) -> DataFrame:
    """Word counts per page and bin, empty bins included.

    Bins are counted first; the empty ones come from a sequence over each page.
    """
    inside = words.select(*keys, centre.alias("c"), width.alias("w")).filter("c >= 0 and c < w")
    counts = inside.groupBy(*keys, F.floor(F.col("c") / BIN).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    pages = words.select(*keys, width.alias("w")).groupBy(*keys).agg(F.max("w").alias("w"))
    every = pages.select(*keys, F.explode(F.sequence(F.lit(0), (F.ceil(F.col("w") / BIN) - 1).cast("int"))).alias("bin"))
    return every.join(sorted_join(counts), [*keys, "bin"], "left").select(*keys, "bin", F.coalesce("n", F.lit(0)).alias("n"))


def gutters(bins: DataFrame, keys: list[str], width: Column) -> DataFrame:
    """The widest run of sparse bins near the middle of each page (leftmost of
    equals), as ``gutter_start, gutter_end``; narrow ones are dropped."""
    page = Window.partitionBy(*keys)
    n_bins = F.ceil(width / BIN)
    low = F.greatest(F.lit(1.0), F.sum("n").over(page) / n_bins * LOW_SHARE)
    mid = F.floor(width / 2 / BIN)
    radius = -(-RADIUS // BIN)
    near = bins.withColumn("_low", F.col("n") <= low).filter((F.col("bin") >= F.greatest(F.lit(0), mid - radius)) & (F.col("bin") < F.least(n_bins, mid + radius)))
    # sparse bins of one run share the number of dense bins before them
    runs = near.withColumn("_run", F.sum(F.when(F.col("_low"), 0).otherwise(1)).over(page.orderBy("bin"))).filter("_low")
    spans = runs.groupBy(*keys, "_run").agg(F.min("bin").alias("a"), (F.max("bin") + 1).alias("b"))
    best = spans.groupBy(*keys).agg(F.max(F.struct((F.col("b") - F.col("a")).alias("size"), (-F.col("a")).alias("neg"))).alias("x"))
    picked = best.select(*keys, (-F.col("x.neg") * BIN).alias("gutter_start"), ((F.col("x.size") - F.col("x.neg")) * BIN).alias("gutter_end"))
    return picked.filter(F.col("gutter_end") - F.col("gutter_start") >= LEAST_GUTTER)


def column_bounds(words: DataFrame, found: DataFrame, keys: list[str], x_min: str, x_max: str) -> DataFrame:
    """Bounds of the columns on both sides of a gutter with enough words."""
    centre = (F.col(x_min) + F.col(x_max)) / 2
    sided = words.join(found, keys).withColumns({"_l": centre < F.col("gutter_start"), "_r": centre > F.col("gutter_end")})
    side = lambda f, c, s: f(F.when(F.col(s), F.col(c)))
    out = sided.groupBy(*keys).agg(F.count_if("_l").alias("n_left"), F.count_if("_r").alias("n_right"), side(F.min, x_min, "_l").alias("left_min"), side(F.max, x_max, "_l").alias("left_max"), side(F.min, x_min, "_r").alias("right_min"), side(F.max, x_max, "_r").alias("right_max"))
    return out.filter((F.col("n_left") >= LEAST_SIDE) & (F.col("n_right") >= LEAST_SIDE))


def nearer_left(centre: Column) -> Column:
    """Whether a caption belongs to the left column (ties do)."""
    return F.abs(centre - (F.col("left_min") + F.col("left_max")) / 2) <= F.abs(centre - (F.col("right_min") + F.col("right_max")) / 2)


def crop_box(caption: Column, top: Column, bottom: Column, width: Column, height: Column, left: Column, right: Column, pinned: Column) -> Column:
    """Struct (x_min, y_min, x_max, y_max) in points, or null."""
    y0 = F.when(pinned, float(HEADER_SKIP)).otherwise(F.coalesce(top, F.greatest(F.lit(0.0), caption - CAPTION_MARGIN)))
    y1 = F.when(pinned, F.greatest(F.lit(HEADER_SKIP + 1.0), caption - CAPTION_GAP)).otherwise(F.coalesce(bottom, F.least(height, caption + CAPTION_MARGIN)))
    x0, x1 = F.greatest(F.lit(0.0), left - BLEED), F.least(width, right + BLEED)
    narrow = left.isNotNull() & right.isNotNull() & (x1 > x0)
    box = F.struct(F.when(narrow, x0).otherwise(0.0).alias("x_min"), y0.alias("y_min"), F.when(narrow, x1).otherwise(width).alias("x_max"), y1.alias("y_max"))
    return F.when(y1 > y0, box)


def crop_pixels(box: Column, page_width: Column, dpi: int = DPI) -> Column:
    """Struct (x, y, w, h) in pixels, or null if nothing is left."""
    scale = dpi / 72
    full = F.ceil(page_width * scale)
    x, y = F.greatest(F.lit(0), F.floor(box["x_min"] * scale)), F.greatest(F.lit(0), F.floor(box["y_min"] * scale))
    w = F.least(full - x, F.ceil((box["x_max"] - box["x_min"]) * scale))
    h = F.ceil((box["y_max"] - box["y_min"]) * scale)
    return F.when((w > 0) & (h > 0), F.struct(x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h")))


def text_density(words: DataFrame, crops: DataFrame, keys: list[str]) -> DataFrame:
    """``ratio, mostly_text`` per crop: covered share of its area.

    Words and crops of a page meet by an equi-join on its keys; the overlap is
    a filter on the joined rows.
    """
    joined = crops.join(words, keys, "left")
    w = F.least("x_max", "cx_max") - F.greatest("x_min", "cx_min")
    h = F.least("y_max", "cy_max") - F.greatest("y_min", "cy_min")
    area = (F.col("cx_max") - F.col("cx_min")) * (F.col("cy_max") - F.col("cy_min"))
    covered = F.sum(F.when((w > 0) & (h > 0), w * h).otherwise(0.0))
    out = joined.groupBy(*keys, area.alias("area")).agg(covered.alias("covered"))
    ratio = F.when(F.col("area") > 0, F.col("covered") / F.col("area")).otherwise(0.0)
    return out.select(*keys, ratio.alias("ratio")).withColumn("mostly_text", F.col("ratio") > MOSTLY_TEXT)


def caption_words(words: DataFrame, keys: list[str], seq: str, text: str, token: Column) -> DataFrame:
    """The first ``Figure <token>`` pair of adjacent words per page."""
    order = Window.partitionBy(*keys).orderBy(seq)
    paired = words.withColumn("_next", F.lead(text).over(order)).withColumn("_token", token)
    rest = F.substring(F.col("_next"), F.length("_token") + 1, F.length("_next"))
    follows = F.startswith(F.lower("_next"), F.lower("_token")) & rest.rlike("^([.:,]|$)")
    hits = paired.filter(F.col(text).rlike(r"(?i)^(figure|fig\.?)$") & follows)
    return hits.groupBy(*keys).agg(F.min(seq).alias(seq))


def locate_page(pages: DataFrame, doc: str, page: str, text: str, label: Column) -> DataFrame:
    """``doc, page`` of a figure: the first page with its caption, else the
    first that mentions it."""
    rows = pages.withColumn("_token", figure_token(label)).filter("_token <> ''")
    # tokens are digits, dots and letters: a dot is the only one to escape
    safe = F.replace("_token", F.lit("."), F.lit(r"\."))
    trailer = F.when(F.col("_token").contains("."), r"(?!\d)").otherwise(r"(?![\d.]\d)")
    caption = F.concat(F.lit(r"(?im)(?:^|\n)\s*(?:Figure|Fig\.?)\s+"), safe, trailer, F.lit(r"\s*[.:]"))
    mention = F.concat(F.lit(r"(?i)(?:^|\s)(?:Figure|Fig\.?)\s+"), safe, trailer)
    rank = F.when(F.regexp_like(text, caption), 0).when(F.regexp_like(text, mention), 1)
    ranked = rows.withColumn("_rank", rank).filter("_rank is not null")
    return ranked.groupBy(doc).agg(F.min(F.struct("_rank", page)).alias("x")).select(doc, F.col(f"x.{page}").alias(page))


def has_embedded(images: DataFrame, keys: list[str]) -> DataFrame:
    """Pages with an embedded image that is large enough."""
    return images.filter((F.col("type") == "image") & (F.col("width") >= EMBEDDED_WIDTH) & (F.col("height") >= EMBEDDED_HEIGHT)).select(*keys).distinct()


def largest_image(images: DataFrame, keys: list[str]) -> DataFrame:
    """``path`` of the largest extracted image (columns ``path, size``) of each
    key; the first by name among equals."""
    return images.groupBy(*keys).agg(F.min(F.struct((-F.col("size")).alias("_order"), "path")).alias("_x")).select(*keys, F.col("_x.path").alias("path"))


def find_pages(asks: DataFrame, pages: DataFrame) -> DataFrame:
    """``pdf, label, page_hint, page``: a hinted page must exist and is taken as
    it is; otherwise the page is located by caption or mention."""
    counted = pages.groupBy("pdf").agg(F.max("page").alias("n_pages"))
    hinted = asks.filter("page_hint is not null").join(sorted_join(counted), "pdf").filter("page_hint between 1 and n_pages").select("pdf", "label", "page_hint", F.col("page_hint").alias("page"))
    free = asks.filter("page_hint is null").select("pdf", "label")
    texts = free.join(sorted_join(pages.select("pdf", "page", "text")), "pdf").withColumn("_ask", F.struct("pdf", "label"))
    located = locate_page(texts, "_ask", "page", "text", F.col("label"))
    found = located.select("_ask.pdf", "_ask.label", F.lit(None).cast("int").alias("page_hint"), "page")
    return hinted.unionByName(found)


def derive_crops(asks: DataFrame, pages: DataFrame, words: DataFrame, images: DataFrame) -> DataFrame:
    """Crops of asked figures: ``pdf, label, page, tier, box, pixels``.

    ``asks`` (pdf, label, page_hint), ``pages`` (pdf, page, width, height,
    text), ``words`` (pdf, page, seq, x_min, y_min, x_max, y_max, text),
    ``images`` (pdf, page, type, width, height). Words of other pages are
    dropped before anything is computed. Without a hint, pages that are mostly
    code or prose give no crop; a caption must be found in any case.
    """
    keys = ["pdf", "page"]
    found = find_pages(asks, pages).filter(figure_token(F.col("label")) != "")
    sized = found.join(sorted_join(pages.select(*keys, F.col("width").alias("page_width"), F.col("height").alias("page_height"), F.col("text").alias("page_text"))), keys).filter("page_width > 0 and page_height > 0")
    sized = sized.filter(F.col("page_hint").isNotNull() | ~is_code_or_prose(F.col("page_text"))).drop("page_text")
    near = words.join(sorted_join(sized.select(*keys, "page_width").distinct()), keys)
    asked = near.drop("page_width").join(sorted_join(sized.select(*keys, "label")), keys)
    captions = caption_words(asked, [*keys, "label"], "seq", "text", figure_token(F.col("label")))
    placed = captions.join(sorted_join(words.select(*keys, "seq", F.col("y_min").alias("caption"), ((F.col("x_min") + F.col("x_max")) / 2).alias("centre"))), [*keys, "seq"]).drop("seq")

    many = near.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") >= LEAST_WORDS).select(*keys)
    wide = near.join(sorted_join(many), keys)
    centre = (F.col("x_min") + F.col("x_max")) / 2
    bins = column_bins(wide, keys, centre, F.col("page_width")).join(sorted_join(sized.select(*keys, "page_width").distinct()), keys)
    sides = column_bounds(wide, sorted_join(gutters(bins, keys, F.col("page_width"))), keys, "x_min", "x_max").select(*keys, "left_min", "left_max", "right_min", "right_max")

    ys = near.groupBy(*keys).agg(F.collect_list("y_min").alias("ys"))
    joined = sized.join(sorted_join(placed), [*keys, "label"]).join(sorted_join(ys), keys).join(sorted_join(sides), keys, "left")
    above = bucket_rows(F.filter("ys", lambda y: y < F.col("caption") - CAPTION_MARGIN))
    below = bucket_rows(F.filter("ys", lambda y: y > F.col("caption") + CAPTION_MARGIN))
    rows = joined.withColumns({"_above": above, "_below": below})
    to_left = nearer_left(F.col("centre"))
    pick = lambda a, b: F.when(F.col("left_min").isNotNull(), F.when(to_left, F.col(a)).otherwise(F.col(b)))
    edges = rows.withColumns({"_top": gap_above(F.col("_above"), F.col("caption")), "_bottom": gap_below(F.col("_below"), F.col("caption"), F.col("page_height")), "_l": pick("left_min", "right_min"), "_r": pick("left_max", "right_max")})
    box = crop_box(F.col("caption"), F.col("_top"), F.col("_bottom"), F.col("page_width"), F.col("page_height"), F.col("_l"), F.col("_r"), F.col("page_hint").isNotNull())
    tiers = has_embedded(images, keys).withColumn("tier", F.lit("embedded"))
    boxed = edges.withColumn("box", box).filter("box is not null").join(sorted_join(tiers), keys, "left")
    return boxed.select("pdf", "label", "page", F.coalesce("tier", F.lit("vector")).alias("tier"), "box", crop_pixels(F.col("box"), F.col("page_width")).alias("pixels"))


def gated_images(wanted: DataFrame, crops: DataFrame, density: DataFrame, key: str) -> DataFrame:
    """Which records keep their image: ``wanted`` (key, source_figure, pdf) asks
    for one by directive; it goes if there is no directive, no PDF, no crop, or
    a crop that is mostly text. An embedded image is not measured."""
    made = crops.select(key, "tier").join(sorted_join(density.select(key, "mostly_text")), key, "left")
    joined = wanted.join(sorted_join(made), key, "left")
    reason = F.when(F.col("source_figure").isNull(), "no directive").when(F.col("pdf").isNull(), "no PDF").when(F.col("tier").isNull(), "no crop").when((F.col("tier") != "embedded") & F.coalesce("mostly_text", F.lit(False)), "mostly text")
    return joined.select(key, reason.isNull().alias("kept"), reason.alias("reason"))
