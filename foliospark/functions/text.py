"""Text operators as Column functions (no Python runs on executors)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Limits on raw and stripped page text, and on identifiers.
PAGE_LIMIT = 200_000
RAW_FACTOR = 3
ID_LIMIT, URL_SLUG_LIMIT, FALLBACK_SLUG_LIMIT = 64, 80, 50
#: Entities in the order in which they are decoded.
ENTITIES = (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"))
#: Directive lines of a focus note.
FIGURE_LINE = r"(?i)^\s*image\s*:\s*((?:figure|fig\.?)\s*\d+(?:\.\d+)?[a-z]?)\s*$"
CAPTION_LINE = r"(?i)^\s*image[_-]caption\s*:\s*(.+?)\s*$"
ALT_LINE = r"(?i)^\s*image[_-]alt\s*:\s*(.+?)\s*$"
PAGE_LINE = r"(?i)^\s*image[_-]page[_-]hint\s*:\s*(.+?)\s*$"
FOCUS_URL = r"(?i)^(\S+)\s+#\s*focus\s*:\s*(.+)$"


def trim_all(c: Column) -> Column:
    """Strip white space of any kind at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.when(F.length(trim_all(c)) > 0, trim_all(c))


def decode_entities(c: Column) -> Column:
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def strip_html(html: Column) -> Column:
    """Readable text of a page: scripts, comments and tags become spaces."""
    out = F.regexp_replace(html, r"(?i)<(script|style)[^>]*>[\s\S]*?</\1>", " ")
    out = F.regexp_replace(F.regexp_replace(out, r"<!--[\s\S]*?-->", " "), "<[^>]+>", " ")
    return trim_all(F.regexp_replace(decode_entities(out), r"\s{2,}", " "))


def page_text(html: Column) -> Column:
    """Bounded page text; the raw page is cut before any pattern runs."""
    return F.substring(strip_html(F.substring(html, 1, PAGE_LIMIT * RAW_FACTOR)), 1, PAGE_LIMIT)


def html_to_plain(html: Column) -> Column:
    """Inline markup to text: tags vanish without leaving a space."""
    return trim_all(decode_entities(F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]+>", "")))


def safe_slug(c: Column) -> Column:
    return F.regexp_replace(c, "[^a-zA-Z0-9_-]", "-")


def pdf_custom_id(filename: Column) -> Column:
    stem = F.regexp_replace(filename, r"(?i)\.pdf$", "")
    return F.substring(F.concat(F.lit("explainer-"), safe_slug(stem)), 1, ID_LIMIT)


def url_custom_id(url: Column) -> Column:
    slug = safe_slug(F.regexp_replace(url, r"^https?://", ""))
    return F.concat(F.lit("explainer-url-"), F.substring(slug, 1, URL_SLUG_LIMIT))


def is_pdf_name(name: Column) -> Column:
    return F.lower(name).endswith(".pdf")


def is_pdf_url(url: Column) -> Column:
    """A path that ends in .pdf or lies under a preprint server's pdf folder."""
    path = F.substring_index(F.lower(url), "?", 1)
    return path.endswith(".pdf") | path.contains("arxiv.org/pdf/")


def is_comment_or_blank(line: Column) -> Column:
    return (F.length(trim_all(line)) == 0) | trim_all(line).startswith("#")


def _last(lines: Column, pattern: str) -> Column:
    """First group of ``pattern`` in the last line that matches it."""
    hits = F.filter(lines, lambda x: x.rlike(pattern))
    return F.regexp_extract(F.try_element_at(hits, F.lit(-1)), pattern, 1)


def figure_label(found: Column) -> Column:
    """``fig``/``fig.`` with a space after it becomes ``Figure``."""
    label = F.trim(found)
    short = F.element_at(F.split(label, r"\s+"), 1).rlike(r"(?i)^fig\.?$")
    long_form = F.trim(F.regexp_replace(F.regexp_replace(label, r"(?i)^fig\.?", "Figure"), r"\s+", " "))
    return F.when(short, long_form).otherwise(F.regexp_replace(label, "(?i)^figure", "Figure"))


def focus_directives(note: Column) -> Column:
    """Struct of (hint, source_figure, caption, alt_text, page_hint).

    The last directive of a kind wins; other lines form the hint. Caption, alt
    text and page hint are null unless a figure was named.
    """
    lines = F.split(note, "\n")
    figure = figure_label(_last(lines, FIGURE_LINE))
    number = lambda x: F.regexp_extract(F.regexp_extract(x, PAGE_LINE, 1), r"^\s*([+-]?\d+)", 1).try_cast("int")
    pages = F.filter(F.transform(lines, number), lambda n: n > 0)
    rest = F.filter(lines, lambda x: ~(x.rlike(FIGURE_LINE) | x.rlike(CAPTION_LINE) | x.rlike(ALT_LINE) | x.rlike(PAGE_LINE)))
    named = figure.isNotNull()
    return F.struct(
        blank_to_null(F.array_join(rest, "\n")).alias("hint"),
        figure.alias("source_figure"),
        F.when(named, _last(lines, CAPTION_LINE)).alias("caption"),
        F.when(named, _last(lines, ALT_LINE)).alias("alt_text"),
        F.when(named, F.try_element_at(pages, F.lit(-1))).alias("page_hint"),
    )


def split_url_line(line: Column) -> Column:
    """Struct of (url, note) for ``url # focus: note`` lines."""
    has = line.rlike(FOCUS_URL)
    return F.struct(F.when(has, F.regexp_extract(line, FOCUS_URL, 1)).otherwise(line).alias("url"), F.when(has, F.trim(F.regexp_extract(line, FOCUS_URL, 2))).alias("note"))


def figure_token(label: Column) -> Column:
    return F.regexp_extract(label, r"(?i)(\d+(?:\.\d+)?[a-z]?)", 1)


def lane_id(base: Column, lane: Column) -> Column:
    return F.concat(base, F.lit("::lane::"), lane)


def lane_base(custom_id: Column) -> Column:
    return F.regexp_extract(custom_id, r"^(.*)::lane::([a-z]+)$", 1)


def lane_name(custom_id: Column) -> Column:
    return F.regexp_extract(custom_id, r"^(.*)::lane::([a-z]+)$", 2)


def strip_frontmatter(text: Column) -> Column:
    """Drop a leading block between two ``---`` lines, if it is closed."""
    body = F.regexp_extract(text, r"^[^\S\n]*---[^\S\n]*\n(?:[\s\S]*?\n)??[^\S\n]*---[^\S\n]*(?:\n([\s\S]*))?$", 1)
    has = text.rlike(r"^[^\S\n]*---[^\S\n]*\n(?:[\s\S]*?\n)??[^\S\n]*---[^\S\n]*(?:\n|$)")
    return F.when(has, F.regexp_replace(body, r"^\s+", "")).otherwise(text)


def word_count(line: Column) -> Column:
    return F.size(F.filter(F.split(line, r"\s+"), lambda w: F.length(w) > 0))


#: Line patterns of code, and the thresholds of the page test.
CODE_LINES = (r"^#\s+\S", r"^\w[\w.]*\s*=\s*\S", r"\bdef\s+\w+\s*\(", r"\bimport\s+\w+", r"^[a-z_]\w*\(.*\)\s*[{;]?$")
LEAST_LINES, CODE_SHARE, PROSE_LINES, PROSE_WORDS = 8, 0.25, 30, 7


def is_code_or_prose(page: Column) -> Column:
    """A page that is mostly code, or dense running text."""
    lines = F.filter(F.transform(F.split(page, "\n"), trim_all), lambda x: F.length(x) > 0)
    n = F.size(lines)
    code = F.size(F.filter(lines, lambda x: F.greatest(*(x.rlike(p) for p in CODE_LINES))))
    words = F.aggregate(lines, F.lit(0), lambda total, x: total + word_count(x))
    return F.when(n < LEAST_LINES, False).when(code / n > CODE_SHARE, True).otherwise((n >= PROSE_LINES) & (words / n >= PROSE_WORDS))


def source_reference(kind: Column, url: Column, path: Column) -> Column:
    local = F.concat(F.lit("Local PDF path: "), path, F.lit("\nRead this local PDF file directly from disk and base the analysis only on this source."))
    return F.when(kind == "url", F.concat(F.lit("Paper reference URL: "), url)).otherwise(local)


def output_filename(slug: Column, custom_id: Column, today: str) -> Column:
    """File name of a result; path separators in a slug are made harmless."""
    named = F.concat(F.regexp_replace(F.regexp_replace(slug, r"\.json$", ""), r"[/\\]", "-"), F.lit(".json"))
    stem = F.substring(F.regexp_replace(custom_id, r"^explainer-(?:url-)?", ""), 1, FALLBACK_SLUG_LIMIT)
    return F.when(F.length(slug) > 0, named).otherwise(F.concat(F.lit(f"{today}_"), stem, F.lit("_explainer.json")))


def html_name(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, "[^/]+$", 0), r"\.json$", ".html")


def round4(x: Column) -> Column:
    """Round half up at four decimals of the binary value times 10000."""
    return F.floor(x * 10000 + 0.5) / 10000


def usd(x: Column) -> Column:
    return F.format_string("$%.4f", x)


def iso_date(stamp: Column) -> Column:
    """The date of an ISO timestamp."""
    return F.substring(stamp, 1, 10)


def merged(base: Column, over: Column) -> Column:
    """Entries of two maps; those of ``over`` win unless they are null."""
    return F.map_zip_with(base, over, lambda _, x, y: F.coalesce(y, x))


def without_keys(entries: Column, *keys: str) -> Column:
    return F.map_filter(entries, lambda k, _: ~k.isin(*keys))


def positive_int(text: Column, fallback: Column) -> Column:
    value = text.try_cast("double")
    return F.when(value > 0, F.floor(value)).otherwise(fallback)
