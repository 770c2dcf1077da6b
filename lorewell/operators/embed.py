"""Text to vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..config import EMBED_BATCH
from ..functions.text import tokens, with_instruction

# Seven digits stay within an int.
HASH_DIGITS = 7
# Words and rows counted at once; one row of more words is counted alone.
COUNT_WORDS = 1 << 19
COUNT_ROWS = 1 << 10

Embedder = Callable[[list[str]], Sequence[Sequence[float]]]


def embed_text(
    df: DataFrame,
    text_col: str = "text",
    embedding_col: str = "embedding",
    dim: int = 256,
    instruction: str | None = None,
    make_embedder: Callable[[], Embedder] | None = None,
    batch_size: int = EMBED_BATCH,
) -> DataFrame:
    """Add an `array<float>` embedding of a text column.

    By default a hashed bag of lower-cased words with unit length: slots come
    from built-in functions, counts from one array operation per Arrow batch.
    `make_embedder` plugs in a model: it is called once per task, and
    what it returns gets at most `batch_size` texts per call.
    """
    text = with_instruction(text_col, instruction)
    if make_embedder is None:
        return _hashed(df, text, embedding_col, dim)

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_embedder()
        for batch in batches:
            texts = batch.tolist()
            vectors: list = []
            for start in range(0, len(texts), batch_size):
                vectors += [list(v) for v in model(texts[start : start + batch_size])]
            yield pd.Series(vectors, dtype=object)

    return df.withColumn(embedding_col, embed(text))


def word_slots(text: Column, dim: int) -> Column:
    """The slot of every word: the leading hex digits of its md5, modulo `dim`.

    Any engine with md5 computes the same slots.
    """
    words = F.coalesce(tokens(F.lower(text)), F.array().cast("array<string>"))
    return F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, HASH_DIGITS), 16, 10).cast("int") % dim)


def unit_counts(slots: pa.Array, dim: int) -> pa.Array:
    """Slot counts of every row, scaled to unit length; rows without words are zero.

    Rows are counted some at a time, so that what is held besides the batch and
    its vectors does not grow with them.
    """
    slots = slots.fill_null([]) if slots.null_count else slots
    ends = np.cumsum(slots.value_lengths().to_numpy())
    unit = np.zeros((len(slots), dim), np.float32)
    first = done = 0
    while first < len(slots):
        last = min(int(np.searchsorted(ends, done + COUNT_WORDS, "right")), first + COUNT_ROWS)
        last = min(max(last, first + 1), len(slots))
        part = slots.slice(first, last - first)
        row = np.repeat(np.arange(len(part)) * dim, part.value_lengths().to_numpy())
        row += part.flatten().to_numpy()
        counts = np.bincount(row, minlength=len(part) * dim).reshape(len(part), dim).astype(np.float64)
        norms = np.sqrt((counts * counts).sum(1, keepdims=True))
        unit[first:last] = np.divide(counts, norms, out=counts, where=norms > 0)
        first, done = last, int(ends[last - 1])
    offsets = np.arange(len(slots) + 1, dtype=np.int32) * dim
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(unit.ravel()))


def _hashed(df: DataFrame, text: Column, embedding_col: str, dim: int) -> DataFrame:
    @F.arrow_udf("array<float>")
    def vector(slots: pa.Array) -> pa.Array:
        return unit_counts(slots, dim)

    # Slots travel in the narrowest type that holds them.
    kind = "array<smallint>" if dim <= 1 << 15 else "array<int>"
    return df.withColumn(embedding_col, vector(word_slots(text, dim).cast(kind)))
