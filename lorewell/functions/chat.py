"""Columns over a messages array, `array<struct<role, content>>`."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import _col


def question(messages: Column | str) -> Column:
    """Content of the last message; null when there is none."""
    return F.try_element_at(_col(messages), F.lit(-1))["content"]


def history(messages: Column | str) -> Column:
    """All messages but the last."""
    c = _col(messages)
    return F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0)))


def render(messages: Column | str) -> Column:
    """One `role: content` line per message."""
    return F.array_join(
        F.transform(_col(messages), lambda m: F.concat(m["role"], F.lit(": "), m["content"])),
        "\n",
    )


def last_turns(messages: Column | str, n: int) -> Column:
    """The last `n` messages."""
    c = _col(messages)
    return F.slice(c, F.greatest(F.size(c) - n + 1, F.lit(1)), F.lit(n))


def retrieval_query(messages: Column | str, n_turns: int) -> Column:
    """Contents of the last `n_turns` history messages, then the question."""
    recent = last_turns(_col(messages), n_turns + 1)
    return F.array_join(F.transform(recent, lambda m: m["content"]), " ")


def join_context(texts: Column | str) -> Column:
    """Retrieved passages separated by a blank line."""
    return F.array_join(_col(texts), "\n\n")
