"""Pages and texts to bounded chunks."""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Callable, Iterable
from itertools import accumulate, groupby

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..config import CorpusConfig
from ..functions import html as markup
from ..functions.text import chunk_id, token_count, tokens

# Coarse-to-fine separators, and the same token rule as the JVM.
SEPARATORS = ("\n\n", "\n", " ")
WORD = re.compile(r"\S+", re.ASCII)


def count_words(text: str) -> int:
    return len(WORD.findall(text))


def cut_in_half(text: str, size: int, count: Callable[[str], int]) -> list[str]:
    """Cut an unbroken run of characters until every part fits."""
    if len(text) < 2 or count(text) <= size:
        return [text]
    middle = len(text) // 2
    return cut_in_half(text[:middle], size, count) + cut_in_half(text[middle:], size, count)


def pack(parts: Iterable[str], glue: str, size: int, overlap: int, count) -> list[str]:
    """Join neighbouring parts up to `size`; repeat up to `overlap` at each cut.

    The glue counts too, for counters that see it, such as character counts.
    """
    between = count(glue)
    chunks: list[str] = []
    window: deque[tuple[str, int]] = deque()
    total = 0
    for part in parts:
        n = count(part) + between
        if window and total + n - between > size:
            chunks.append(glue.join(p for p, _ in window))
            while window and (total - between > overlap or total + n - between > size):
                total -= window.popleft()[1]
        window.append((part, n))
        total += n
    if window:
        chunks.append(glue.join(p for p, _ in window))
    return chunks


def split_text(text: str, size: int, overlap: int, count=count_words, separators=SEPARATORS) -> list[str]:
    """Split at the coarsest separator present; only parts that do not fit go finer."""
    text = text.strip()
    if not text:
        return []
    if count(text) <= size:
        return [text]
    present = [i for i, s in enumerate(separators) if s in text]
    if not present:
        return pack(cut_in_half(text, size, count), "", size, overlap, count)
    glue = separators[present[0]]
    finer = separators[present[0] + 1 :]
    chunks: list[str] = []
    fitting: list[str] = []
    for part in filter(None, text.split(glue)):
        if count(part) < size:
            fitting.append(part)
            continue
        chunks += pack(fitting, glue, size, overlap, count)
        fitting = []
        chunks += split_text(part, size, overlap, count, finer)
    return chunks + pack(fitting, glue, size, overlap, count)


def merge_sections(sections: Iterable[tuple[str, str]], size: int, count=count_words) -> list[str]:
    """Neighbouring sections as one block while they fit half a chunk.

    Every section is counted once. Running totals that start anew where the
    limit is passed give each section its block number; blocks are joined at the
    end, so the text is never counted or copied as it grows.
    """
    blocks = [f"{header}\n{text}" for header, text in sections]
    glue = count("\n")

    def place(state: tuple[int, int], n: int) -> tuple[int, int]:
        number, filled = state
        fits = filled + n <= size / 2
        return (number, filled + n + glue) if fits else (number + 1, n + glue)

    numbers = list(accumulate(map(count, blocks), place, initial=(0, 0)))[1:]
    together = groupby(zip(numbers, blocks), key=lambda pair: pair[0][0])
    joined = ("\n".join(block for _, block in members).strip() for _, members in together)
    return [text for text in joined if text]


def chunk_page(headers, texts, size: int, overlap: int, minimum: int, count=count_words) -> list[str]:
    decoded = [(html.unescape(h), html.unescape(t)) for h, t in zip(headers, texts)]
    chunks = [
        c for block in merge_sections(decoded, size, count) for c in split_text(block, size, overlap, count)
    ]
    return [c for c in chunks if count(c) > minimum]


def chunk_pages(
    pages: DataFrame,
    config: CorpusConfig = CorpusConfig(),
    html_col: str = "html_content",
    text_col: str = "text",
    token_counter: Callable[[str], int] | None = None,
) -> DataFrame:
    """Pages to chunk rows: the other page columns, `pos`, the text, `n_tokens`.

    The article is found and cut into sections by built-in expressions, so
    only its text crosses to Python, in Arrow batches. Pages without the
    container or without a chunk above the minimum give no row.
    """
    size, overlap, minimum = config.chunk_size, config.chunk_overlap, config.min_chunk_size
    count = token_counter or count_words

    @F.pandas_udf("array<string>")
    def chunks_of(headers: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series(
            [chunk_page(h, t, size, overlap, minimum, count) for h, t in zip(headers, texts)],
            dtype=object,
        )

    body = markup.container_body(html_col, *config.container)
    found = markup.sections(body, config.header)
    keep = [c for c in pages.columns if c != html_col]
    # `inline` hands on one finished value per page; as plain columns, the
    # optimizer would repeat the parse for the filter and for each field.
    cut = pages.select(
        *keep,
        F.inline(F.filter(F.array(F.struct(found.alias("_sections"))), lambda r: F.size(r["_sections"]) > 0)),
    )
    cut = cut.select(
        *keep, chunks_of(F.col("_sections.header"), F.col("_sections.text")).alias("_chunks")
    )
    rows = cut.select(*keep, F.posexplode("_chunks").alias("pos", text_col))
    return rows.withColumn("n_tokens", token_count(text_col))


def sliding_chunks(
    docs: DataFrame,
    text_col: str,
    config: CorpusConfig = CorpusConfig(),
    chunk_col: str = "text",
) -> DataFrame:
    """Fixed windows of tokens with overlap, entirely with built-in expressions.

    A window starts every `size - overlap` tokens; windows of at most
    `min_chunk_size` tokens are dropped.
    """
    size, step = config.chunk_size, config.chunk_size - config.chunk_overlap
    if step <= 0:
        raise ValueError("chunk_overlap must be smaller than chunk_size")
    keep = [c for c in docs.columns if c != text_col]
    words = docs.select(*keep, tokens(text_col).alias("_words"))
    # No filter on the word count: it would be pushed down and count twice.
    starts = F.when(F.size("_words") > 0, F.sequence(F.lit(0), F.size("_words") - 1, F.lit(step)))
    windows = F.transform(starts, lambda s: F.slice(F.col("_words"), s + 1, F.lit(size)))
    long_enough = F.filter(
        F.transform(windows, lambda w: F.struct(F.size(w).alias("n"), F.array_join(w, " ").alias("t"))),
        lambda w: w["n"] > config.min_chunk_size,
    )
    rows = words.select(*keep, F.posexplode(long_enough).alias("pos", "_w"))
    return rows.select(*keep, "pos", F.col("_w.t").alias(chunk_col), F.col("_w.n").alias("n_tokens"))


def with_chunk_id(chunks: DataFrame, doc_uri: str = "doc_uri", text: str = "text") -> DataFrame:
    return chunks.withColumn("chunk_id", chunk_id(doc_uri, "pos", text))


def chunk_statistics(chunks: DataFrame, doc: str = "doc_uri") -> DataFrame:
    """Number and size range of the chunks of each document."""
    return chunks.groupBy(doc).agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.min("n_tokens").alias("min_tokens"),
        F.max("n_tokens").alias("max_tokens"),
    )
