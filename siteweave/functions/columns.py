"""Column-to-column helpers; all of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

__all__ = [
    "has_number",
    "has_text",
    "has_items",
    "default_if_falsy",
    "as_key",
    "code_name",
    "epoch_timestamp",
    "utc_year",
    "iso_stamp",
    "first_chars",
    "strip_text",
    "thumb_url",
    "company_prompt",
    "site_prompt",
    "persona_prompt",
    "row_json",
    "json_object",
    "strip_tag",
    "tag_label",
    "display_label",
    "tooltip",
    "schema_line",
    "catalogue_line",
    "strip_backticks",
    "first_or",
    "text_or",
    "fetch_status",
]

# What Python's str.strip() removes: ASCII and Unicode white space.
_SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"


def has_number(col: Column) -> Column:
    """Truthiness of a number: null and 0 are false."""
    return F.coalesce(col != 0, F.lit(False))


def has_text(col: Column) -> Column:
    """Truthiness of a string: null and '' are false."""
    return F.coalesce(col != "", F.lit(False))


def has_items(col: Column) -> Column:
    """Truthiness of a list: null and [] are false."""
    return F.coalesce(F.size(col) > 0, F.lit(False))


def default_if_falsy(guard: Column, col: Column, default) -> Column:
    """`col` where its truthiness `guard` holds, else `default`."""
    return F.when(guard, col).otherwise(F.lit(default))


def as_key(col: Column) -> Column:
    """Graph keys are strings throughout."""
    return col.cast("string")


def code_name(col: Column, names: Mapping[int, str] = fixed.GAME_TYPES) -> Column:
    """Name of a code from a small fixed dictionary; null for unknown codes."""
    pairs = [F.lit(part) for item in names.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), col.cast("int"))


def epoch_timestamp(seconds: Column) -> Column:
    """Epoch seconds as a zone-free UTC timestamp, whatever the session's zone."""
    origin = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return origin + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def utc_year(seconds: Column) -> Column:
    return F.year(epoch_timestamp(seconds))


def iso_stamp(timestamp: Column) -> Column:
    """ISO-8601 text; whole seconds carry no fraction."""
    full = F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, r"\.000000$", "")


def first_chars(col: Column, n: int = fixed.SITE_TEXT_CHARS) -> Column:
    return F.substring(col, 1, n)


def strip_text(col: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.regexp_replace(col, f"^{_SPACE}+|{_SPACE}+$", "")


def thumb_url(
    template: Column, width: int = fixed.THUMB_WIDTH, height: int = fixed.THUMB_HEIGHT
) -> Column:
    sized = F.replace(template, F.lit("{width}"), F.lit(str(width)))
    return F.replace(sized, F.lit("{height}"), F.lit(str(height)))


def company_prompt(name: Column) -> Column:
    return F.format_string(fixed.COMPANY_PROMPT, name)


def site_prompt(text: Column) -> Column:
    return F.format_string(fixed.SITE_PROMPT, text)


def persona_prompt(row: Column) -> Column:
    return F.format_string(fixed.PERSONA_PROMPT, row)


def row_json(cols: Sequence[str]) -> Column:
    """One JSON object from the named columns of a row."""
    return F.to_json(F.struct(*cols))


def json_object(col: Column) -> Column:
    """String map of a JSON object; null for bad JSON and for non-objects."""
    return F.from_json(col, "map<string,string>")


def strip_tag(entity: Column) -> Column:
    """B-ORG, I-ORG -> ORG."""
    return F.replace(F.replace(entity, F.lit("B-"), F.lit("")), F.lit("I-"), F.lit(""))


def tag_label(entity: Column) -> Column:
    """Node label of an entity tag."""
    tag = strip_tag(entity)
    other = F.concat(F.upper(F.substring(tag, 1, 1)), F.lower(F.substr(tag, F.lit(2))))
    return F.when(tag == "ORG", fixed.COMPANY).when(tag == "PRODUCT", fixed.PRODUCT).otherwise(other)


def display_label(props: Column, label: Column) -> Column:
    """First non-empty of name, title, id; then the node label; then 'Node'."""
    choices = [F.nullif(F.try_element_at(props, F.lit(key)), F.lit("")) for key in ("name", "title", "id")]
    return F.coalesce(*choices, F.nullif(label, F.lit("")), F.lit("Node"))


def tooltip(props: Column) -> Column:
    """`key: value` lines in key order."""
    lines = F.transform(
        F.array_sort(F.map_entries(props)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])
    )
    return F.array_join(lines, "<br>")


def schema_line(src: Column, rel: Column, dst: Column) -> Column:
    return F.format_string("%s -[:%s]-> %s", src, rel, dst)


def catalogue_line(label: Column, names: Column) -> Column:
    return F.concat(label, F.lit(": "), F.array_join(names, ", "))


def strip_backticks(col: Column) -> Column:
    return F.replace(col, F.lit("`"), F.lit(""))


def first_or(items: Column, default) -> Column:
    """First element of a list, or the default for an empty or missing list."""
    return F.coalesce(F.try_element_at(items, F.lit(1)), F.lit(default))


def text_or(col: Column, default: str = "") -> Column:
    """Value of a possibly missing nested field."""
    return F.coalesce(col, F.lit(default))


def fetch_status(text: Column) -> Column:
    """Outcome of a page fetch, read off the markers stored in place of the text."""
    return (
        F.when(text.isNull(), "missing")
        .when(text.contains(fixed.HTTP_ERROR), "http_error")
        .when(text.contains(fixed.REQUEST_ERROR), "request_error")
        .otherwise("ok")
    )
