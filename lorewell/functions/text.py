"""Text columns: versions, whitespace, tokens, ids, templates."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Fixed patterns. A token is a run of non-blank characters. The strip pattern
# covers Unicode blanks and the four ASCII separators that Python strips too.
TOKEN = r"\S+"
LEADING_BLANKS = r"^(?U)[\s\x1c-\x1f]+"
TRAILING_BLANKS = r"(?U)[\s\x1c-\x1f]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` evaluated once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def version_number(uri: Column | str) -> Column:
    """Text after the last slash of a version URI."""
    return F.substring_index(_col(uri), "/", -1)


def strip(text: Column | str) -> Column:
    """Remove leading and trailing whitespace of every kind, not only blanks."""
    left = F.regexp_replace(_col(text), LEADING_BLANKS, "")
    return F.regexp_replace(left, TRAILING_BLANKS, "")


def tokens(text: Column | str) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(TOKEN), F.lit(0))


def token_count(text: Column | str) -> Column:
    return F.regexp_count(_col(text), F.lit(TOKEN))


def word_set(text: Column | str) -> Column:
    """Distinct lower-cased tokens."""
    return F.array_distinct(tokens(F.lower(_col(text))))


def chunk_id(doc_uri: Column | str, pos: Column | str, text: Column | str) -> Column:
    """Id that survives task retries and rebuilds: it depends on content only."""
    parts = F.concat_ws("|", _col(doc_uri), _col(pos).cast("string"), _col(text))
    return F.sha2(parts, 256)


def relative_path(uri: Column | str, prefix: str) -> Column:
    """The URI without `prefix`; URIs outside the prefix stay whole."""
    c = _col(uri)
    if not prefix:
        return c
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def with_instruction(text: Column | str, instruction: str | None) -> Column:
    """Put the model instruction before the text when there is one."""
    if not instruction:
        return _col(text)
    return F.concat_ws(" ", F.lit(instruction), _col(text))


def fill_template(template: str, **values: Column | str) -> Column:
    """Fill `{name}` placeholders with columns.

    The template is cut once on the driver, so a placeholder that occurs inside
    a value is never filled again. Null values become empty text.
    """
    parts: list[Column] = []
    last = 0
    for match in re.finditer(r"\{(\w+)\}", template):
        name = match.group(1)
        if name not in values:
            raise ValueError(f"template needs a value for {{{name}}}")
        if match.start() > last:
            parts.append(F.lit(template[last : match.start()]))
        parts.append(F.coalesce(_col(values[name]).cast("string"), F.lit("")))
        last = match.end()
    if last < len(template):
        parts.append(F.lit(template[last:]))
    return F.concat(*parts) if parts else F.lit("")
