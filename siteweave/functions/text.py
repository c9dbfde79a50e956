"""Text work as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

__all__ = ["html_to_text", "decode_entities", "distinct_tokens", "schema_tokens", "canonical_case", "words", "WORD"]

# A word as Python's \w sees it, whatever the alphabet.
WORD = r"[\p{L}\p{N}_]+"
_NAMED = {f"&{name};": chr(point) for name, point in name2codepoint.items()} | {"&apos;": "'"}


def html_to_text(html: Column, entities: Mapping[str, str] = _NAMED) -> Column:
    """Visible text of a page: no scripts, styles, templates, comments or tags; references decoded.

    The page is read once from left to right, so that whatever begins first ends first.
    A tag ends behind its quoted attributes, or at the next `>` if a quote stays open. An
    unclosed script, style, template or comment runs to the end of the page. A `<` without any `>` behind
    it is text.

    The time is in proportion to the page, whatever is open in it. What could read on to the end
    again and again is a tag that doesn't end. Up to the last `>` every tag ends at some `>`, and at most
    two can have a quote open to the end of the page: with a `>` between them, their readings are in different
    states of (no quote, single, double), a quote permutes these states, and neither reading may be outside
    quotes. Behind the last `>` only a comment matters.
    """
    last = F.length(html) - F.instr(F.reverse(html), ">") + 1
    some = html.contains(">")
    head = F.when(some, F.substr(html, F.lit(1), last)).otherwise("")
    tail = F.when(some, F.substr(html, last + 1)).otherwise(html)
    read = _without_tags(head)
    # A script or comment that is open at the end of the head takes in whatever follows.
    inside = F.length(_without_tags(F.concat(head, F.lit(" ")))) == F.length(read)
    rest = F.when(inside, "").otherwise(F.regexp_replace(tail, r"(?s)<!--.*", ""))
    whole = F.when(tail.contains("<"), F.concat(read, rest)).otherwise(_without_tags(html))
    return decode_entities(whole, entities)


def _without_tags(html: Column) -> Column:
    attributes = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
    hidden = rf"<(script|style|template)\b{attributes}>.*?(?:</\1\s*>|\z)"
    pattern = rf"(?is)<!--.*?(?:-->|\z)|{hidden}|</?[a-z]{attributes}>|<[a-z/!?][^>]*+>"
    return F.regexp_replace(html, pattern, "")


def decode_entities(text: Column, entities: Mapping[str, str] = _NAMED) -> Column:
    """Replace character references in one pass, so `&amp;lt;` gives `&lt;`."""
    named = F.create_map(*[F.lit(part) for item in entities.items() for part in item])

    def piece(part: Column) -> Column:
        decimal = F.nullif(F.regexp_extract(part, r"^&#0*([0-9]{1,7});$", 1), F.lit(""))
        hexadecimal = F.nullif(F.regexp_extract(part, r"^&#[xX]0*([0-9a-fA-F]{1,6});$", 1), F.lit(""))
        return (
            F.when(~part.startswith("&") | (F.length(part) == 1), part)
            .when(decimal.isNotNull(), _character(decimal.cast("long"), part))
            .when(hexadecimal.isNotNull(), _character(F.conv(hexadecimal, 16, 10).cast("long"), part))
            .otherwise(F.coalesce(F.try_element_at(named, part), part))
        )

    parts = F.regexp_extract_all(text, F.lit(r"(&#?[A-Za-z0-9]+;|[^&]+|&)"), 1)
    return F.when(text.contains("&"), F.array_join(F.transform(parts, piece), "")).otherwise(text)


def _character(point: Column, otherwise: Column) -> Column:
    valid = ((point > 0) & (point < 0xD800)) | ((point > 0xDFFF) & (point <= 0x10FFFF))
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")).otherwise(otherwise)


def distinct_tokens(text: Column, pattern: str) -> Column:
    """Distinct captures of the pattern's first group, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 1)))


def schema_tokens(text: Column) -> dict[str, Column]:
    """Label, relationship and property names mentioned in schema text."""
    return {
        "labels": distinct_tokens(text, fixed.LABEL_TOKEN),
        "rels": distinct_tokens(text, fixed.REL_TOKEN),
        "props": distinct_tokens(text, fixed.PROPERTY_TOKEN),
    }


def canonical_case(
    text: Column, labels: Iterable[str] = (), rels: Iterable[str] = (), props: Iterable[str] = ()
) -> Column:
    """Give whole words the schema's own spelling, ignoring case.

    The vocabulary is the schema's names, so it stays small. A spelling shared by
    several kinds goes to the last kind, as if the kinds were replaced in turn.
    """
    spelling = {name.lower(): name for kind in (labels, rels, props) for name in sorted(kind)}
    if not spelling:
        return text
    lookup = F.create_map(*[F.lit(part) for item in spelling.items() for part in item])
    parts = F.regexp_extract_all(text, F.lit(rf"({WORD}|[^\p{{L}}\p{{N}}_]+)"), 1)
    return F.array_join(
        F.transform(parts, lambda w: F.coalesce(F.try_element_at(lookup, F.lower(w)), w)), ""
    )


def words(text: Column) -> Column:
    """Lower-case words in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(rf"({WORD})"), 1)
