"""Near copies by the Jaccard similarity of their sets of five-word shingles.

Documents with equal sets are one node. Two sets of a similarity of 4/5 or more
share a member among the first n - ceil(4n/5) + 1 of each, in any one order of
all shingles (prefix filter), so no link is lost. The order puts shingles that
are frequent in a part of the texts last; it decides how many candidates there
are, never the result. Each candidate is confirmed by its exact similarity.

Candidates come in two steps: every node with the least and the greatest node
of each shared shingle; then all pairs that are still in different components.
So a group of copies costs one pair a node and not the square of its size.

Shingles are 64-bit hashes of words as `simhash` cuts them; a text of fewer
words is one shingle, and texts without words are equal.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import words as W
from .components import star_components
from .scratch import column, free_name, freeze, freeze_python
from .xxh64 import xxh64

SHINGLE = 5
SIMILARITY = Fraction(4, 5)
SEED = 42
BLOCK_BYTES = 1 << 20
# Texts that show which shingles are frequent, and shingles of them that are sent to all tasks.
SHOWN = 8192
FREQUENT = 200_000


def _sets(block: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the shingles of all texts, and their bounds."""
    words = W.joined_by_space(W.cut(block, lower=True))
    counts, begin = words.counts, words.bounds[:-1]
    long, short = np.flatnonzero(counts >= shingle), np.flatnonzero((counts > 0) & (counts < shingle))
    n = counts[long] - shingle + 1
    grams = W.gram_hashes(W.word_hashes(words), shingle)
    h, doc = grams[W.spans(begin[long], n)], np.repeat(long, n)
    if len(short):
        whole = xxh64(words.data, words.start[begin[short]], words.end[begin[short] + counts[short] - 1], SEED)
        h, doc = np.concatenate([h, whole]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(block) + 1))


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE):
    """Blocks of (first text, sorted distinct hashes of all texts, their bounds)."""
    for first, block in W.blocks(texts, BLOCK_BYTES):
        yield first, *_sets(block, shingle)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _longs(h: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(h.view(np.int64)))


def _frequent(docs: DataFrame, text_col: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that occur repeatedly in some texts, ascending, and how often (as a power of two)."""
    share = max(1, docs.count() // SHOWN)

    def emit(batches):
        for batch in batches:
            for _, h, _ in shingle_sets(batch.column(0), shingle):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    some = docs.select(column(text_col).alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)
    counts = some.mapInArrow(emit, "h long").groupBy("h").count().filter("count > 2")
    found = freeze_python(counts, "near-frequent").toArrow()
    h, count = found.column(0).to_numpy().view(np.uint64), found.column(1).to_numpy()
    most = np.lexsort((h, -count))[:FREQUENT]
    h, level = h[most], np.frexp(count[most].astype(np.float64))[1].astype(np.uint64)
    order = np.argsort(h)
    return h[order], level[order]


def _prefixes(rows: DataFrame, frequent, shingle: int, similarity: Fraction) -> DataFrame:
    """(row, node, n, prefix) of (row, text)."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent)
    num, den = similarity.numerator, similarity.denominator

    def emit(batches):
        known, levels = shared.value
        for batch in batches:
            for first, h, bounds in shingle_sets(batch.column(1), shingle):
                n = np.diff(bounds)
                node = W.mix(_sums(W.mix(h), bounds) + n.astype(np.uint64))
                level = np.zeros(len(h), np.uint64)
                if len(known) and len(h):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    level = np.where(known[at] == h, levels[at], level)
                order = np.lexsort((h, level, np.repeat(np.arange(len(n)), n)))
                length = np.where(n > 0, n + 1 - -(-num * n // den), 0)
                prefix = h[order][W.spans(bounds[:-1], length)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(n)), pa.array(node.view(np.int64)), pa.array(n.astype(np.int32)),
                        _longs(prefix, np.concatenate([[0], np.cumsum(length)])),
                    ],
                    names=["row", "node", "n", "prefix"],
                )

    return rows.mapInArrow(emit, "row long, node long, n int, prefix array<long>")


def _confirmed(pairs: DataFrame, rows: DataFrame, prints: DataFrame, shingle: int, similarity: Fraction) -> DataFrame:
    """The pairs (a, b, na, nb) of nodes whose sets are similar enough."""
    num, den = similarity.numerator, similarity.denominator
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    chosen = prints.join(asked, "node", "left_semi").groupBy("node").agg(F.min("row").alias("row"))
    # Texts travel, not sets: they are half as large when compressed.
    texts = rows.join(chosen, "row").select("node", "text")

    def emit(batches):
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            for first, block in W.blocks(left, BLOCK_BYTES):
                a, of_a = _sets(block, shingle)
                b, of_b = _sets(right.slice(first, len(block)), shingle)
                na, nb, every = np.diff(of_a), np.diff(of_b), np.arange(len(block))
                pair = np.concatenate([np.repeat(every, na), np.repeat(every, nb)])
                h = np.concatenate([a, b])
                order = np.lexsort((h, pair))
                h, pair = h[order], pair[order]
                common = np.bincount(pair[1:][(h[1:] == h[:-1]) & (pair[1:] == pair[:-1])], minlength=len(block))
                alike = np.flatnonzero((num + den) * common >= num * (na + nb)) + first
                yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(alike)) for i in (0, 1)], names=["a", "b"])

    both = pairs.select("a", "b").join(texts.toDF("a", "left"), "a").join(texts.toDF("b", "right"), "b")
    return freeze_python(both.select("a", "b", "left", "right").mapInArrow(emit, "a long, b long"), "near-links")


def _sized(similarity: Fraction):
    """Whether the sizes na and nb allow the similarity."""
    num, den = similarity.numerator, similarity.denominator
    return den * F.least("na", "nb").cast("long") >= num * F.greatest("na", "nb").cast("long")


def _links(rows: DataFrame, prints: DataFrame, shingle: int, similarity: Fraction) -> DataFrame:
    """Links (a, b) that connect all nodes which similar pairs connect."""
    by = Window.partitionBy("h")
    me = F.struct("node", "n")
    posts = prints.select("node", "n", F.explode("prefix").alias("h"))
    posts = posts.withColumn("lo", F.min(me).over(by)).withColumn("hi", F.max(me).over(by))
    posts = freeze(posts.filter("lo.node < hi.node").distinct(), "near-shared")
    low = posts.select(F.col("lo.node").alias("a"), F.col("node").alias("b"), F.col("lo.n").alias("na"), F.col("n").alias("nb"))
    high = posts.select(F.col("node").alias("a"), F.col("hi.node").alias("b"), F.col("n").alias("na"), F.col("hi.n").alias("nb"))
    first = freeze(low.union(high).filter(F.expr("a < b") & _sized(similarity)).distinct(), "near-pairs")
    links = _confirmed(first, rows, prints, shingle, similarity)

    roots = star_components(links)
    rooted = posts.select("h", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = rooted.withColumn("lo", F.min("root").over(by)).withColumn("hi", F.max("root").over(by))
    open_ = freeze(open_.filter("lo < hi").select("h", "node", "n", "root"), "near-open")
    left, right = open_.toDF("h", "x", "nx", "rx"), open_.toDF("h", "y", "ny", "ry")
    pairs = left.join(right, "h").filter("rx < ry").select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
        F.when(F.col("x") < F.col("y"), F.col("nx")).otherwise(F.col("ny")).alias("na"),
        F.when(F.col("x") < F.col("y"), F.col("ny")).otherwise(F.col("nx")).alias("nb"),
    ).filter(_sized(similarity)).distinct()
    pairs = freeze(pairs.join(first.select("a", "b"), ["a", "b"], "left_anti"), "near-pairs")
    return links.union(_confirmed(pairs, rows, prints, shingle, similarity))


def components_of(rows: DataFrame, shingle: int = SHINGLE, similarity: Fraction = SIMILARITY) -> DataFrame:
    """(row, root) of a stored table (row, text) with distinct rows: equal roots are linked."""
    prints = freeze_python(_prefixes(rows, _frequent(rows, "text", shingle), shingle, similarity), "near-prints")
    roots = star_components(_links(rows, prints, shingle, similarity))
    return prints.select("row", "node").join(roots, "node", "left").select("row", F.coalesce("root", "node").alias("root"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component: that of the least id, nulls last, and of equal ids the first stored."""
    row = free_name("row", docs.columns)
    stored = freeze(docs.withColumn(row, F.monotonically_increasing_id()), "near-docs")
    rows = stored.select(column(row).alias("row"), column(text_col).alias("text"))
    ids = stored.select(column(row).alias("row"), column(id_col).alias("id"))
    found = freeze(components_of(rows, **options).join(ids, "row"), "near-roots")
    # Stored, so that the join can split a large component.
    first = F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"]
    kept = freeze(found.groupBy("root").agg(first.alias("kept")), "near-groups")
    drop = free_name("dropped_row", stored.columns)
    gone = found.join(kept, "root").filter("row != kept").select(F.col("row").alias(drop))
    return stored.join(gone, column(row) == column(drop), "left_anti").drop(row)
