"""JSON from noisy model output, and typed questions to VARIANT values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliospark.functions.text import trim_all

FENCE = r"(?is)```(?:json)?\s*(\{[\s\S]*\})\s*```"


def json_candidate(raw: Column) -> Column:
    """The part of ``raw`` that should be JSON: the object in a code fence,
    else from the first brace to the last, else all of it."""
    start, tail = F.instr(raw, "{"), F.instr(F.reverse(raw), "}")
    last = F.length(raw) - tail + 1
    braces = F.substring(raw, start, last - start + 1)
    return F.when(raw.rlike(FENCE), F.regexp_extract(raw, FENCE, 1)).when((start > 0) & (tail > 0) & (last > start), braces).otherwise(trim_all(raw))


def parse_strict(text: Column) -> Column:
    """VARIANT of exactly one JSON value, else null.

    The parser alone would accept text after the value. Inside brackets that
    text makes the array invalid or longer than one, unless it closes them; then
    it is invalid as a member of an object.
    """
    wrapped = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    member = F.try_parse_json(F.concat(F.lit('{"a":'), text, F.lit("}")))
    return let(wrapped, lambda x: F.when((F.size(x) == 1) & member.isNotNull(), F.get(x, F.lit(0))))


def extract_json(raw: Column) -> Column:
    return let(raw, lambda x: parse_strict(json_candidate(x)))


def get(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "variant")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is named once: the expression's size stays
    linear however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_SHALLOW = {"object": "struct<>", "array": "array<variant>"}
_SCALARS = {"string": "^STRING$", "boolean": "^BOOLEAN$", "null": "^VOID$", "number": "^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)"}


def _inner(v: Column) -> Column:
    return is_kind(v, "object") | is_kind(v, "array")


def is_kind(v: Column, name: str) -> Column:
    """Whether a value is an ``object array string number boolean null``.

    Objects and arrays are told by their head; the schema, which would go through
    all that is in them, is taken of other values only.
    """
    if name in _SHALLOW:
        return F.try_variant_get(v, "$", _SHALLOW[name]).isNotNull()
    return F.when(_inner(v), F.lit(False)).otherwise(F.coalesce(F.schema_of_variant(v), F.lit("")).rlike(_SCALARS[name]))


def text(v: Column) -> Column:
    return F.when(is_kind(v, "string"), F.try_variant_get(v, "$", "string"))


def number(v: Column) -> Column:
    return F.when(is_kind(v, "number"), F.try_variant_get(v, "$", "double"))


def items(v: Column) -> Column:
    """The elements of an array value, else an empty array."""
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))


def falsy(v: Column) -> Column:
    """Absent, null, '', 0 or false."""
    return F.when(_inner(v), F.lit(False)).otherwise(F.coalesce(F.to_json(v), F.lit("null")).rlike(r'^(null|""|-?0(\.0*)?(E.*)?|false)$'))


def blank(v: Column) -> Column:
    """Not a string with a visible character."""
    return F.coalesce(F.length(trim_all(text(v))) == 0, F.lit(True))
