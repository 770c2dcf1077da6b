"""Tolerant HTML handling with built-in expressions.

The page is cut with regular expressions that never nest a repeat inside a
repeat. An opener always matches: without its closer it runs to the end of the
page, as in browsers, so no text is scanned again from the next opener and the
time grows with the page even for hostile ones.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .text import _col, let

# Fixed patterns for markup that carries no text, for tags that end a line, and
# for the character references decoded on the JVM side.
HIDDEN_MARKUP = (
    r"(?is)<!--(?:-?>|.*?(?:-->|\z))|<script\b.*?(?:</script\s*+>|\z)|<style\b.*?(?:</style\s*+>|\z)"
)
LINE_BREAK_TAG = (
    r"(?i)</?(?:p|br|div|li|ul|ol|tr|table|pre|section|article|blockquote|hr|h[1-6])\b[^>]*+(?:>|\z)"
)
ANY_TAG = r"</?[a-zA-Z!][^>]*+(?:>|\z)"
CHARACTER_REFERENCES = (
    ("&nbsp;?", " "),
    ("&lt;?", "<"),
    ("&gt;?", ">"),
    ("&quot;?", '"'),
    ("&#39;?", "'"),
    ("&copy;?", "©"),
    ("&middot;?", "·"),
    ("&amp;?", "&"),
)


def without_hidden_markup(html: Column | str) -> Column:
    """Drop comments, scripts and styles, whichever opens first."""
    return F.regexp_replace(_col(html), HIDDEN_MARKUP, "")


def open_tag_pattern(tag: str, attribute: str | None, value: str | None) -> str:
    """The opening tag; a tag broken off by the next one is none."""
    name = re.escape(tag)
    if attribute is None:
        return rf"(?is)<{name}(?:\s[^<>]*+)?>"
    key = re.escape(attribute)
    if value is None:
        return rf"(?is)<{name}\s(?:[^<>]*\s)?{key}\b[^<>]*+>"
    wanted = re.escape(value)
    return rf"(?is)<{name}\s(?:[^<>]*\s)?{key}\s*=\s*[\"']?{wanted}(?=[\"'\s>])[^<>]*+>"


def container_body(
    html: Column | str, tag: str, attribute: str | None = None, value: str | None = None
) -> Column:
    """Inner markup of the first element `tag[attribute=value]`; null if absent.

    Elements of the same tag may nest: the text after the opening tag is cut
    before every opening or closing tag of that name, and a running depth finds
    the piece that starts with the matching close. An element that is never
    closed runs to the end of the page.
    """
    page = without_hidden_markup(html)
    after = F.split(page, open_tag_pattern(tag, attribute, value), 2)
    rest = F.try_element_at(after, F.lit(2))
    name = re.escape(tag)
    pieces = F.split(rest, rf"(?i)(?=</?{name}[\s>/])")
    closing = rf"(?i)^</{name}[\s>/]"
    opening = rf"(?i)^<{name}[\s>/]"
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("kept"))

    def step(acc: Column, piece: Column) -> Column:
        depth = (
            F.when(acc["depth"] == 0, F.lit(0))
            .when(piece.rlike(closing), acc["depth"] - 1)
            .when(piece.rlike(opening), acc["depth"] + 1)
            .otherwise(acc["depth"])
        )
        kept = F.when(depth > 0, acc["kept"] + 1).otherwise(acc["kept"])
        return F.struct(depth.alias("depth"), kept.alias("kept"))

    def inside(p: Column) -> Column:
        kept = F.aggregate(p, start, step, lambda acc: acc["kept"])
        return F.array_join(F.slice(p, F.lit(1), kept), "")

    return let(pieces, inside)


def markup_to_text(markup: Column | str) -> Column:
    """Visible text: block tags end a line, other tags vanish, blanks collapse.

    Character references are left as they are.
    """
    c = F.regexp_replace(_col(markup), r"\s{2,}|[\t\n\x0B\f\r]", " ")
    c = F.regexp_replace(c, LINE_BREAK_TAG, "\n")
    c = F.regexp_replace(c, ANY_TAG, "")
    c = F.regexp_replace(c, r" *\n\s*", "\n")
    c = F.regexp_replace(c, r" {2,}", " ")
    return F.regexp_replace(F.regexp_replace(c, r"^\s+", ""), r"\s+$", "")


def decode_references(text: Column | str) -> Column:
    """Decode the common character references; `&amp;` last, so once only.

    As in browsers, the closing semicolon may be missing.
    """
    c = _col(text)
    for reference, char in CHARACTER_REFERENCES:
        c = F.regexp_replace(c, reference, char)
    return c


def article_text(
    html: Column | str, tag: str, attribute: str | None = None, value: str | None = None
) -> Column:
    return decode_references(markup_to_text(container_body(html, tag, attribute, value)))


def sections(body: Column | str, header: str) -> Column:
    """Cut markup before each `header` tag: `array<struct<header, text>>`.

    Text before the first header gets an empty header. References are not
    decoded here; the chunker does that for every named and numbered one.
    """
    name = re.escape(header)
    parts = F.split(_col(body), rf"(?i)(?=<{name}[\s>])")
    whole_header = rf"(?is)\A<{name}(?:\s[^<>]*+)?>(.*?)</{name}\s*+>"

    def describe(part: Column) -> Column:
        title = F.regexp_replace(markup_to_text(F.regexp_extract(part, whole_header, 1)), r"\s+", " ")
        content = markup_to_text(F.regexp_replace(part, whole_header, ""))
        return F.struct(title.alias("header"), content.alias("text"))

    return F.filter(
        F.transform(parts, describe),
        lambda s: (s["header"] != "") | (s["text"] != ""),
    )
