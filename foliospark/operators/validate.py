"""Structural validation of extracted records: 51 rules, issues in order.

Every rule is a Column; arrays are checked with higher-order functions, so a
record never leaves the JVM. Issue texts are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliospark.functions import jsonx as J

#: Anchors that open safely, bare addresses, dates.
ANCHOR_A = r"""(?i)<a\s[^>]*href=["']https?://[^"']+["'][^>]*target=["']_blank["'][^>]*rel=["'][^"']*noopener[^"']*noreferrer[^"']*["'][^>]*>"""
ANCHOR_B = r"""(?i)<a\s[^>]*href=["']https?://[^"']+["'][^>]*rel=["'][^"']*noopener[^"']*noreferrer[^"']*["'][^>]*target=["']_blank["'][^>]*>"""
ANY_ANCHOR = r"(?i)<a\b[\s\S]*?</a>"
BARE_URL = r"""(?i)https?://[^\s<>"']+"""
PUBLISHED = r"^Published [A-Z][a-z]+ \d{4}$"
PILLS = (2, 6)
MOST_CHARTS = 4

NONE = "array<string>"


#: The text of each rule's issue; {} stands for an index, the date or
#: a value.
MESSAGES = {
    "V1": "Output is not a JSON object.",
    "V2": "Missing or incorrect version field (expected 1).",
    "V3": "Missing metadata object.",
    "V4": "Missing metadata.title.",
    "V5": "Missing metadata.filename_slug.",
    "V6": "Missing metadata.date_created.",
    "V7": "metadata.date_created must equal {}.",
    "V8": "metadata.filename_slug must match {}_authorsurname_short-title_explainer.",
    "V9": "Missing hero object.",
    "V10": "Missing hero.headline.",
    "V11": "Missing hero.headline_html.",
    "V12": "Missing hero.subtitle.",
    "V13": "Missing hero.publication_date.",
    "V14": 'hero.publication_date must use the format "Published Month Year".',
    "V15": "Missing top_block.",
    "V16": "top_block.pills is empty or missing.",
    "V17": "top_block.pills must contain between 2 and 6 pills.",
    "V18": "top_block.pills[{}] is not an object.",
    "V19": "top_block.pills[{}].number is empty.",
    "V20": "top_block.pills[{}].description is empty.",
    "V21": "top_block.pills[{}].accent_color is empty.",
    "V22": "top_block.body is empty (takeaway).",
    "V23": 'top_block.kind must be "pills" or "takeaway".',
    "V24": "Missing or empty sections array.",
    "V25": "sections[{}] is not an object.",
    "V26": "sections[{}] missing label.",
    "V27": "sections[{}] must include paragraphs or a structured list.",
    "V28": "sections[{}] contains empty paragraph entries.",
    "V29": "sections[{}].paragraphs_html must align with paragraphs length.",
    "V30": "sections[{}].list.ordered must be boolean.",
    "V31": "sections[{}].list.items must contain at least 1 item.",
    "V32": "sections[{}].list.items[{}] is not an object.",
    "V33": "sections[{}].list.items[{}].body is empty.",
    "V34": 'end_takeaway must be omitted when top_block.kind is "takeaway".',
    "V35": 'end_takeaway must be present when top_block.kind is "pills".',
    "V36": "charts must be an array when present.",
    "V37": "charts must not contain more than 4 entries.",
    "V38": "charts[{}].title is empty.",
    "V39": "charts[{}].caption is empty.",
    "V40": "charts[{}] must include config_json or config_raw.",
    "V41": "charts[{}].datasets[{}].data is an ordinal sequence ({}) - bar height is encoding rank order, not magnitude. Move to a numbered list or prose, or replace with measured values.",
    "V42": "charts[{}].datasets[{}].data is a two-value share-of-whole ({} sums to ~{}). Move to top_block.pills - a proportion is not a chart.",
    "V43": "chart must be an object when present.",
    "V44": "image must be an object when present.",
    "V45": "image.source_figure is empty.",
    "V46": "image.caption is empty.",
    "V47": "Missing references array.",
    "V48": "references must contain the primary source citation.",
    "V49": "references[{}] is empty.",
    "V50": 'references[{}] must include a clickable external anchor with target="_blank" and rel="noopener noreferrer".',
    "V51": "references[{}] contains a bare URL outside an anchor tag.",
}

#: The lines around the issues in a repair request; {} is the date.
REPAIR_LINES = (
    "You are repairing a JSON explainer article.",
    "The JSON you returned violated required schema or formatting rules. Fix the issues below while preserving all existing content.",
    "Use {} as metadata.date_created and as the YYYY-MM-DD prefix in metadata.filename_slug.",
    'hero.publication_date must use the format "Published Month Year".',
    'Every reference must include the primary source URL as an anchor with target="_blank" and rel="noopener noreferrer".',
    'If top_block.kind is "pills", include 2 to 6 pills; if "takeaway", omit end_takeaway.',
)
REPAIR_END = "Return only a valid JSON object starting with { and ending with }. No preamble, no markdown fences."


def _issue(condition: Column, message) -> Column:
    return F.when(condition, message if isinstance(message, Column) else F.lit(message))


def _when_all(*issues: Column) -> Column:
    return F.array_compact(F.array(*issues))


def _each(array: Column, check) -> Column:
    """Issues of every element, in order; ``check(element, index)``."""
    return F.flatten(F.transform(array, check))


def _at(path: str, *parts) -> Column:
    """``path`` with each ``{}`` filled by a column."""
    pieces = path.split("{}")
    out = [F.lit(pieces[0])]
    for part, piece in zip(parts, pieces[1:], strict=True):
        out += [part.cast("string"), F.lit(piece)]
    return F.concat(*out)


def safe_anchor(html: Column) -> Column:
    return html.rlike(ANCHOR_A) | html.rlike(ANCHOR_B)


def bare_url(html: Column) -> Column:
    return F.regexp_replace(html, ANY_ANCHOR, "").rlike(BARE_URL)


def is_ordinal(data: Column) -> Column:
    """At least three numbers in steps of one (up or down) with an end in 0, 1."""
    n = F.size(data)
    steps = F.when(n >= 2, F.transform(F.sequence(F.lit(1), n - 1), lambda k: F.get(data, k) - F.get(data, k - 1))).otherwise(F.array().cast("array<double>"))
    ends = F.get(data, F.lit(0)).isin(0, 1) | F.get(data, n - 1).isin(0, 1)
    return (n >= 3) & ends & (F.forall(steps, lambda d: d == 1) | F.forall(steps, lambda d: d == -1))


def is_share(data: Column) -> Column:
    """Two numbers that add up to a whole."""
    total = F.get(data, F.lit(0)) + F.get(data, F.lit(1))
    return (F.size(data) == 2) & (total.between(95, 105) | total.between(0.95, 1.05))


def _top(v: Column, date: str) -> list[Column]:
    meta, hero, top = v["metadata"], v["hero"], v["top_block"]
    created, slug, published = J.get(meta, "date_created"), J.get(meta, "filename_slug"), J.get(hero, "publication_date")
    in_meta, in_hero, in_top = ~J.falsy(meta), ~J.falsy(hero), ~J.falsy(top)
    pills, n_pills = J.get(top, "pills"), F.size(J.items(J.get(top, "pills")))
    kind = J.text(J.get(top, "kind"))
    by_pills = in_top & F.coalesce(kind == "pills", F.lit(False))
    takeaway = in_top & F.coalesce(kind == "takeaway", F.lit(False))
    no_date = J.falsy(published)

    def pill(p: Column, i: Column) -> Column:
        inside = _when_all(_issue(J.blank(J.get(p, "number")), _at(MESSAGES["V19"], i)), _issue(J.blank(J.get(p, "description")), _at(MESSAGES["V20"], i)), _issue(J.falsy(J.get(p, "accent_color")), _at(MESSAGES["V21"], i)))
        return F.when(J.is_kind(p, "object"), inside).otherwise(F.array(_at(MESSAGES["V18"], i)))

    head = _when_all(
        _issue(~F.coalesce(J.number(v["version"]) == 1, F.lit(False)), MESSAGES["V2"]),
        _issue(~in_meta, MESSAGES["V3"]),
        _issue(in_meta & J.falsy(J.get(meta, "title")), MESSAGES["V4"]),
        _issue(in_meta & J.falsy(slug), MESSAGES["V5"]),
        _issue(in_meta & J.falsy(created), MESSAGES["V6"]),
        _issue(in_meta & (J.text(created) != date), MESSAGES["V7"].replace("{}", date)),
        _issue(in_meta & ~J.text(slug).rlike(f"^{date}_[a-z0-9]+_[a-z0-9-]+_explainer$"), MESSAGES["V8"].replace("{}", date)),
        _issue(~in_hero, MESSAGES["V9"]),
        _issue(in_hero & J.falsy(J.get(hero, "headline")), MESSAGES["V10"]),
        _issue(in_hero & J.falsy(J.get(hero, "headline_html")), MESSAGES["V11"]),
        _issue(in_hero & J.falsy(J.get(hero, "subtitle")), MESSAGES["V12"]),
        _issue(in_hero & no_date, MESSAGES["V13"]),
        _issue(in_hero & ~no_date & ~F.coalesce(J.text(published).rlike(PUBLISHED), F.lit(False)), MESSAGES["V14"]),
        _issue(~in_top, MESSAGES["V15"]),
        _issue(by_pills & (n_pills == 0), MESSAGES["V16"]),
        _issue(by_pills & (n_pills > 0) & ~n_pills.between(*PILLS), MESSAGES["V17"]),
    )
    rest = _when_all(_issue(takeaway & J.falsy(J.get(top, "body")), MESSAGES["V22"]), _issue(in_top & ~by_pills & ~takeaway, MESSAGES["V23"]))
    return [head, F.when(by_pills, _each(J.items(pills), pill)).otherwise(F.array().cast(NONE)), rest]


def _sections(v: Column) -> list[Column]:
    sections = J.items(v["sections"])

    def item(x: Column, i: Column, k: Column) -> Column:
        bad = F.when(~J.is_kind(x, "object"), _at(MESSAGES["V32"], i, k)).when(J.blank(J.get(x, "body")), _at(MESSAGES["V33"], i, k))
        return F.array_compact(F.array(bad))

    def section(s: Column, i: Column) -> Column:
        paragraphs, rich, listed = J.items(J.get(s, "paragraphs")), J.get(s, "paragraphs_html"), J.get(s, "list")
        some, has_list = F.size(paragraphs) > 0, J.is_kind(J.get(s, "list"), "object")
        entries = J.items(J.get(listed, "items"))
        inside = _when_all(
            _issue(J.falsy(J.get(s, "label")), _at(MESSAGES["V26"], i)),
            _issue(~some & ~has_list, _at(MESSAGES["V27"], i)),
            _issue(F.exists(paragraphs, J.blank), _at(MESSAGES["V28"], i)),
            _issue(J.is_kind(rich, "array") & some & (F.size(J.items(rich)) != F.size(paragraphs)), _at(MESSAGES["V29"], i)),
            _issue(has_list & ~J.is_kind(J.get(listed, "ordered"), "boolean"), _at(MESSAGES["V30"], i)),
            _issue(has_list & (F.size(entries) == 0), _at(MESSAGES["V31"], i)),
        )
        full = F.concat(inside, F.when(has_list, _each(entries, lambda x, k: item(x, i, k))).otherwise(F.array().cast(NONE)))
        return F.when(J.is_kind(s, "object"), full).otherwise(F.array(_at(MESSAGES["V25"], i)))

    top, end = v["top_block"], v["end_takeaway"]
    kind = F.when(J.is_kind(top, "object"), J.text(J.get(top, "kind")))
    ends = _when_all(
        _issue((kind == "takeaway") & ~J.falsy(end), MESSAGES["V34"]),
        _issue((kind == "pills") & (~J.is_kind(end, "object") | J.falsy(J.get(end, "body"))), MESSAGES["V35"]),
    )
    return [_when_all(_issue(F.size(sections) == 0, MESSAGES["V24"])), _each(sections, section), ends]


def _charts(v: Column) -> list[Column]:
    listed, single, image = v["charts"], v["chart"], v["image"]
    objects = F.filter(J.items(listed), lambda c: J.is_kind(c, "object"))
    charts = F.when(F.size(objects) > 0, objects).when(J.is_kind(single, "object"), F.array(single)).otherwise(F.array().cast("array<variant>"))

    def dataset(raw: Column, d: Column, i: Column) -> Column:
        return J.let(F.transform(raw, lambda x: F.try_variant_get(x, "$", "double")), lambda data: told(data, F.to_json(raw), d, i))

    def told(data: Column, shown: Column, d: Column, i: Column) -> Column:
        total = F.get(data, F.lit(0)) + F.get(data, F.lit(1))
        share = _at(MESSAGES["V42"], i, d, shown, F.format_string("%.2f", total))
        return _when_all(_issue(is_ordinal(data), _at(MESSAGES["V41"], i, d, shown)), _issue(is_share(data), share))

    def chart(c: Column, i: Column) -> Column:
        sets = J.items(F.try_variant_get(c, "$.config_json.data.datasets", "variant"))
        numbers = F.filter(F.transform(sets, lambda s: F.filter(J.items(J.get(s, "data")), lambda x: J.is_kind(x, "number"))), lambda a: F.size(a) > 0)
        own = _when_all(
            _issue(J.blank(J.get(c, "title")), _at(MESSAGES["V38"], i)),
            _issue(J.blank(J.get(c, "caption")), _at(MESSAGES["V39"], i)),
            _issue(J.get(c, "config_json").isNull() & J.blank(J.get(c, "config_raw")), _at(MESSAGES["V40"], i)),
        )
        return F.concat(own, _each(numbers, lambda a, d: dataset(a, d, i)))

    before = _when_all(_issue(listed.isNotNull() & ~J.is_kind(listed, "array"), MESSAGES["V36"]), _issue(F.size(J.items(listed)) > MOST_CHARTS, MESSAGES["V37"]))
    is_image = J.is_kind(image, "object")
    after = _when_all(
        _issue(single.isNotNull() & ~J.is_kind(single, "object"), MESSAGES["V43"]),
        _issue(image.isNotNull() & ~is_image, MESSAGES["V44"]),
        _issue(is_image & J.blank(J.get(image, "source_figure")), MESSAGES["V45"]),
        _issue(is_image & J.blank(J.get(image, "caption")), MESSAGES["V46"]),
    )
    return [before, _each(charts, chart), after]


def reference_issues(ref: Column, blank: Column, i: Column) -> Column:
    bad = _when_all(
        _issue(~safe_anchor(ref), _at(MESSAGES["V50"], i)),
        _issue(bare_url(ref), _at(MESSAGES["V51"], i)),
    )
    return F.when(blank, F.array(_at(MESSAGES["V49"], i))).otherwise(bad)


def _references(v: Column) -> list[Column]:
    refs = v["references"]
    is_list = J.is_kind(refs, "array")
    before = _when_all(_issue(~is_list, MESSAGES["V47"]), _issue(is_list & (F.size(J.items(refs)) == 0), MESSAGES["V48"]))
    return [before, _each(J.items(refs), lambda r, i: reference_issues(J.text(r), J.blank(r), i))]


def issues(v: Column, expected_date: str) -> Column:
    """All issues of a parsed record (VARIANT), as an array of texts."""
    def parts(x: Column) -> Column:
        return F.concat(F.concat(*_top(x, expected_date)), F.concat(*_sections(x)), F.concat(*_charts(x)), F.concat(*_references(x)))

    keys = ("version", "metadata", "hero", "top_block", "sections", "end_takeaway", "charts", "chart", "image", "references")
    fields = F.struct(*(J.get(v, k).alias(k) for k in keys))
    return F.when(J.is_kind(v, "object"), J.let(fields, parts)).otherwise(F.array(F.lit(MESSAGES["V1"])))


def validation(v: Column, expected_date: str) -> Column:
    """Struct (ok, issues)."""
    found = J.let(v, lambda x: issues(x, expected_date))
    return J.let(found, lambda x: F.struct((F.size(x) == 0).alias("ok"), x.alias("issues")))


def repair_instruction(found: Column, expected_date: str) -> Column:
    """The text that asks for a repair."""
    before = [x.replace("{}", expected_date) for x in REPAIR_LINES]
    lines = F.concat(F.array(*(F.lit(x) for x in before)), F.transform(found, lambda x: F.concat(F.lit("- "), x)), F.array(F.lit(REPAIR_END)))
    return F.array_join(lines, "\n")


__all__ = ["issues", "validation", "repair_instruction", "safe_anchor", "bare_url", "is_ordinal", "is_share"]
