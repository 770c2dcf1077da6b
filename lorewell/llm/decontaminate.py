"""Benchmark decontamination with suffix arrays of the training texts.

Every task cuts its documents into shards of bounded size and sorts all word
suffixes of a shard (prefix doubling, to a depth that covers the window). Each
suffix of each benchmark item is then narrowed down, word by word, by binary
search in the sorted suffixes; what remains are all places that share its first
`window` words. Matches are extended to their longest verbatim form and their
words compared as bytes, so a hash collision cannot make a match. No shuffle.

The benchmark travels in blocks of at most ITEM_BYTES, so what is broadcast at
once has a fixed bound; a larger benchmark takes one pass over the documents per
block.

Null and blank documents have no words and no matches; items without words are
ignored; equal item ids are one item; a null item id counts as the empty string.
An item shorter than the window is one window. Clashing column names keep the
caller's column: results then get underscores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import words as W
from .scratch import column, free_name, freeze

WINDOW = 10
SHARD_BYTES = 2 << 20
ITEM_BYTES = 32 << 20
RESULT = (
    "struct<n_words: bigint, n_hit: bigint, "
    "matches: array<struct<start: bigint, length: bigint, item_id: string, item_start: bigint>>>"
)


@dataclass
class Shard:
    """Hashed words of some documents with their suffixes in sorted order."""

    words: W.Words
    hashes: np.ndarray
    stop: np.ndarray  # per word the end of its document
    order: np.ndarray


def suffix_order(hashes: np.ndarray, stop: np.ndarray, depth: int) -> np.ndarray:
    """Positions of all suffixes, sorted by at least their first `depth` words.

    Words compare by hash; a suffix ends with its document, and an end sorts
    first. Each round doubles the sorted depth and only touches suffixes that
    are still tied.
    """
    n = len(hashes)
    order = np.argsort(hashes)
    if n == 0:
        return order
    rank = np.empty(n, np.int64)
    tied = np.arange(n)
    keys = hashes[order]
    done = 1
    while True:
        new = np.ones(len(tied), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(tied)))
        rank[order[tied]] = np.repeat(tied[first], sizes)
        tied = tied[np.repeat(sizes > 1, sizes)]
        if done >= depth or len(tied) == 0:
            return order
        at = order[tied]
        after = at + done
        inside = after < stop[at]
        second = np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
        keys = rank[at] * (n + 1) + second
        by = np.argsort(keys)
        order[tied] = at[by]
        keys = keys[by]
        done *= 2


def build_shard(texts: pa.Array, depth: int) -> Shard:
    words = W.cut(texts, W.SYMBOL_BYTES, lower=True)
    hashes = W.word_hashes(words)
    stop = np.repeat(words.bounds[1:], words.counts)
    return Shard(words, hashes, stop, suffix_order(hashes, stop, depth))


@dataclass
class Items:
    """Benchmark items as hashed words, with the suffixes to search for."""

    ids: list[str]
    words: W.Words
    hashes: np.ndarray
    suffix: np.ndarray  # first word of each searched suffix
    need: np.ndarray  # words that have to match
    start: np.ndarray  # per word the begin of its item
    stop: np.ndarray


def build_items(ids: list[str], texts: list[str], window: int) -> Items:
    words = W.cut(pa.array(texts, pa.large_string()), W.SYMBOL_BYTES, lower=True)
    counts = words.counts
    n = np.where(counts > 0, np.maximum(counts - window + 1, 1), 0)
    return Items(
        ids, words, W.word_hashes(words), W.spans(words.bounds[:-1], n),
        np.repeat(np.minimum(counts, window), n),
        np.repeat(words.bounds[:-1], counts), np.repeat(words.bounds[1:], counts),
    )


def search(shard: Shard, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Ranges [low, high) of `shard.order` whose suffixes begin like each item suffix."""
    first = shard.hashes[shard.order]
    wanted = items.hashes[items.suffix]
    low, high = np.searchsorted(first, wanted, "left"), np.searchsorted(first, wanted, "right")
    for t in range(1, int(items.need.max(initial=0))):
        open_ = np.flatnonzero((items.need > t) & (low < high))
        if len(open_) == 0:
            continue
        wanted = items.hashes[items.suffix[open_] + t]
        for side in ("left", "right"):
            lo, hi = low[open_].copy(), high[open_].copy()
            while True:
                live = np.flatnonzero(lo < hi)
                if len(live) == 0:
                    break
                mid = (lo[live] + hi[live]) // 2
                at = shard.order[mid]
                inside = at + t < shard.stop[at]
                value = shard.hashes[np.where(inside, at + t, 0)]
                want = wanted[live]
                before = ~inside | ((value < want) if side == "left" else (value <= want))
                lo[live] = np.where(before, mid + 1, lo[live])
                hi[live] = np.where(before, hi[live], mid)
            if side == "left":
                low[open_] = lo
            else:
                high[open_] = lo
    return low, high


def longest_matches(shard: Shard, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document word, item word and length of all matches that cannot be extended."""
    low, high = search(shard, items)
    sizes = np.maximum(high - low, 0)
    p = shard.order[W.spans(low, sizes)]
    q = np.repeat(items.suffix, sizes)
    length = np.repeat(items.need, sizes)
    begin = np.repeat(shard.words.bounds[:-1], shard.words.counts)
    inner = (p > begin[p]) & (q > items.start[q]) if len(p) else np.zeros(0, bool)
    inner[inner] = shard.hashes[p[inner] - 1] == items.hashes[q[inner] - 1]
    p, q, length = p[~inner], q[~inner], length[~inner]
    live = np.arange(len(p))
    while len(live):
        a, b = p[live] + length[live], q[live] + length[live]
        live, a, b = (x[(a < shard.stop[p[live]]) & (b < items.stop[q[live]])] for x in (live, a, b))
        live = live[shard.hashes[a] == items.hashes[b]]
        length[live] += 1
    return _verified(shard.words, items.words, p, q, length)


def _verified(a: W.Words, b: W.Words, p, q, length):
    """The matches whose words are equal byte by byte."""
    wa, wb = W.spans(p, length), W.spans(q, length)
    size = a.end[wa] - a.start[wa]
    wrong = size != b.end[wb] - b.start[wb]
    of = np.repeat(np.arange(len(p)), length)
    good = np.ones(len(p), bool)
    good[of[wrong]] = False
    ok = ~wrong
    different = a.data[W.spans(a.start[wa[ok]], size[ok])] != b.data[W.spans(b.start[wb[ok]], size[ok])]
    good[np.repeat(of[ok], size[ok])[different]] = False
    return p[good], q[good], length[good]


def match_texts(texts: pa.Array, items: Items, window: int) -> pa.Array:
    """RESULT for every text of a batch."""
    n_words, n_hit, counts = [], [], []
    starts, lengths, names, item_starts = [], [], [], []
    ids = np.array(items.ids, object)
    item_of = items.words.doc()
    for _, block in W.blocks(texts, SHARD_BYTES):
        shard = build_shard(block, window)
        p, q, length = longest_matches(shard, items)
        doc = shard.words.doc()
        by = np.lexsort((q, p))
        p, q, length = p[by], q[by], length[by]
        bounds = shard.words.bounds
        hit = W.covered(p, length, len(doc))
        n_words.append(shard.words.counts)
        n_hit.append(np.diff(np.concatenate([[0], np.cumsum(hit)])[bounds]))
        counts.append(np.bincount(doc[p], minlength=len(block)))
        starts.append(p - bounds[doc[p]])
        lengths.append(length)
        names.append(ids[item_of[q]])
        item_starts.append(q - items.start[q])

    def flat(parts, kind=np.int64):
        return np.concatenate([np.zeros(0, kind), *parts])

    struct = pa.StructArray.from_arrays(
        [pa.array(flat(starts)), pa.array(flat(lengths)), pa.array(list(flat(names, object)), pa.string()), pa.array(flat(item_starts))],
        ["start", "length", "item_id", "item_start"],
    )
    offsets = np.concatenate([[0], np.cumsum(flat(counts))]).astype(np.int32)
    return pa.StructArray.from_arrays(
        [pa.array(flat(n_words)), pa.array(flat(n_hit)), pa.ListArray.from_arrays(pa.array(offsets), struct)],
        ["n_words", "n_hit", "matches"],
    )


def _matcher(sent, window: int):
    """The matching function for one broadcast block of items."""

    @F.arrow_udf(RESULT)
    def matched(texts: pa.Array) -> pa.Array:
        return match_texts(texts, sent.value, window)

    return matched


def find_matches(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """`docs` with `n_words`, `n_hit` (words inside a match) and `matches`.

    A match is an array entry (start, length, item_id, item_start) in words, the
    longest that contains its window, at least `window` words or a whole item.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(column(item_col).cast("string"), F.lit("")).alias("id"),
        F.coalesce(column(item_text_col), F.lit("")).alias("text"),
    )
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("id") + 16)).first()[0] or 0
    n_blocks = max(1, -(-size // ITEM_BYTES))
    out = free_name("decontamination", docs.columns)
    for block in range(n_blocks):
        mine = items if n_blocks == 1 else items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == block)
        rows = mine.collect()
        sent = spark.sparkContext.broadcast(build_items([r["id"] for r in rows], [r["text"] for r in rows], window))
        found = _matcher(sent, window)(column(text_col))
        if block:
            # The words hit are counted anew from the matches of all blocks.
            both = F.concat(F.col(f"{out}.matches"), found["matches"])
            found = F.struct(found["n_words"].alias("n_words"), _n_hit(both).alias("n_hit"), both.alias("matches"))
        docs = docs.withColumn(out, found)
        if n_blocks > 1:
            docs = freeze(docs, "decontaminate")
    names = {}
    for name in ("n_words", "n_hit", "matches"):
        names[name] = free_name(name, [c for c in docs.columns if c != out])
    return docs.withColumns({names[k]: F.col(f"{out}.{k}") for k in names}).drop(out)


def _n_hit(matches):
    """Words inside at least one match: ends minus what earlier matches reach."""
    by_start = F.array_sort(matches)
    zero = F.struct(F.lit(0).cast("long").alias("reach"), F.lit(0).cast("long").alias("hit"))

    def step(acc, m):
        end = m["start"] + m["length"]
        fresh = F.greatest(F.lit(0).cast("long"), end - F.greatest(acc["reach"], m["start"]))
        return F.struct(F.greatest(acc["reach"], end).alias("reach"), (acc["hit"] + fresh).alias("hit"))

    return F.aggregate(by_start, zero, step, lambda acc: acc["hit"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` without any match, with their own columns."""
    found = find_matches(docs, benchmark, **options)
    hit = [c for c in found.columns if c not in docs.columns][1]
    return found.filter(column(hit) == 0).select(*[column(c) for c in docs.columns])
