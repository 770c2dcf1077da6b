"""Removal of repeated word spans by a compacted De Bruijn graph of the corpus.

Edges are windows of K words, nodes the K - 1 words two consecutive windows
share. The graph is never held edge by edge: consecutive edges of a document
that share a minimizer (the least hash of their M-word grams) form one path
piece, and equal edges always carry equal minimizers. So:

1. M-grams that make up more than HOT_SHARE of all positions are counted first;
   they rank behind all others as minimizers, so a frequent phrase does not draw
   the edges around it into one group. Each task cuts its texts into path pieces. Edges that also start earlier in
   the same block of documents are removed at once and not sent, a map-side
   combine that keeps frequent passages and copies out of the shuffle.
2. Pieces meet by minimizer, sorted by document and position. An edge met before
   is repeated; its first occurrence, the source coordinate, comes with it.
   Runs whose document and source coordinates advance together stay compact.
   A task streams its pieces and holds the edges of one minimizer, at most
   GROUP_EDGES; edges beyond go on as rows to an aggregation and a join.
3. Runs that continue each other along document and source (no branch between)
   are joined into long spans, per document.
4. Spans are joined to their source text by its coordinates. A 128-bit digest of
   the source's very words goes with the span to its document; only spans whose
   own words have the same digest are removed.

Windows are judged on the input. An earlier occurrence has a smaller id, or the
same id and an earlier start. Null ids come after all others. Rows with equal id
and text are one document and are treated alike; rows with equal id and another
text follow in the order of a hash of the text. Null and blank texts have no
words. Clashing column names keep the caller's column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import words as W
from .scratch import column, free_name, freeze, freeze_python, partitions_for

K = 20
M = 5
BLOCK_BYTES = 2 << 20
GROUP_EDGES = 4_000_000
# At most 2 / HOT_SHARE grams can be hot, which bounds the list sent to tasks.
HOT_SHARE = 2e-5
# Bytes kept of an edge's hash; edges only meet those of the same 64-bit minimizer.
EDGE_BYTES = 6
RESULT = "struct<text: string, n_words: bigint, n_removed: bigint>"


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values."""
    n, size = len(x) - width + 1, 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:n], x[width - size : width - size + n])


def _runs(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of runs; `breaks` is true where one begins."""
    first = np.flatnonzero(breaks)
    return first, np.diff(np.append(first, len(breaks)))


def _first_equal(keys: np.ndarray) -> np.ndarray:
    """For every entry the index of the first entry with the same key."""
    by = np.argsort(keys, kind="stable")
    ordered = keys[by]
    new = np.ones(len(by), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    out = np.empty(len(by), np.int64)
    out[by] = by[np.flatnonzero(new)][np.cumsum(new) - 1]
    return out


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    )


def hot_grams(keyed: DataFrame, m: int, share: float) -> np.ndarray:
    """Sorted hashes of the m-grams that hold more than `share` of all m-gram positions.

    A block reports the grams above half the share of its own positions, so few
    rows leave a task; one that is hot over all blocks is so in at least one, and
    what blocks below half the share hold of it is less than half of its count.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block in W.blocks(batch.column(0), BLOCK_BYTES):
                words = W.cut(block)
                at = W.spans(words.bounds[:-1], np.maximum(words.counts - m + 1, 0))
                if not len(at):
                    continue
                grams, n = np.unique(W.gram_hashes(W.word_hashes(words), m)[at], return_counts=True)
                often = n > max(1.0, share / 2 * len(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(grams[often].view(np.int64), 0)),
                        pa.array(np.append(n[often], 0)),
                        pa.array(np.append(np.zeros(often.sum(), np.int64), len(at))),
                    ],
                    names=["gram", "n", "positions"],
                )

    counted = keyed.select("text").mapInArrow(count, "gram long, n long, positions long")
    sums = freeze_python(counted.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("positions").alias("positions")), "grams")
    total = sums.agg(F.sum("positions")).first()[0] or 0
    hot = sums.filter(F.col("n") > share / 2 * total).filter("n > 1").select("gram").collect()
    return np.sort(np.array([r["gram"] for r in hot], np.int64).view(np.uint64))


def _minimizers(grams: np.ndarray, width: int, hot: np.ndarray) -> np.ndarray:
    """The least gram of every window of `width` grams; hot ones come last."""
    order = grams >> np.uint64(1)
    if len(hot):
        spot = np.minimum(np.searchsorted(hot, grams), len(hot) - 1)
        order |= (hot[spot] == grams).astype(np.uint64) << np.uint64(63)
    return _sliding_min(order, width)


def _pieces_of_block(
    ids: pa.Array, keys: np.ndarray, texts: pa.Array, k: int, m: int, hot: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Path pieces of documents sorted by (id, key), and spans already known as repeated.

    Spans have no edges; they carry their length and source and a minimizer
    that only spreads them.
    """
    words = W.cut(texts)
    hashes = W.word_hashes(words)
    counts = np.maximum(words.counts - k + 1, 0)
    again = np.zeros(len(keys), bool)
    if len(keys) > 1:
        same_id = pc.fill_null(pc.equal(ids[1:], ids[:-1]), False).to_numpy(zero_copy_only=False)
        nulls = ids.is_null().to_numpy(zero_copy_only=False)
        again[1:] = (same_id | (nulls[1:] & nulls[:-1])) & (keys[1:] == keys[:-1])
    counts[again] = 0
    if not counts.sum():
        return
    edge_hashes = W.gram_hashes(hashes, k)
    minimizers = _minimizers(W.gram_hashes(hashes, m), k - m + 1, hot)
    at = W.spans(words.bounds[:-1], counts)
    doc = np.repeat(np.arange(len(counts)), counts)
    edges, anchors = edge_hashes[at], minimizers[at]
    first = _first_equal(edges)
    own = first == np.arange(len(at))
    start = at - words.bounds[doc]
    new_doc = np.ones(len(at), bool)
    new_doc[1:] = doc[1:] != doc[:-1]

    def rows(index: np.ndarray, breaks: np.ndarray, repeated: bool) -> pa.RecordBatch:
        head, size = _runs(breaks)
        lead = index[head]
        d = doc[lead]
        n = len(lead)
        if repeated:
            source = first[lead]
            s = doc[source]
            anchor = W.mix((keys[d].astype(np.uint64) << np.uint64(32)) + lead.astype(np.uint64))
            columns = [pa.nulls(n, pa.binary()), ids.take(pa.array(s)), pa.array(keys[s]), pa.array(start[source].astype(np.int32))]
        else:
            raw = edges[index].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :EDGE_BYTES]
            offsets = np.append(0, np.cumsum(size)) * EDGE_BYTES
            anchor = anchors[lead]
            columns = [_binary(raw, offsets), pa.nulls(n, ids.type), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32())]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(anchor.view(np.int64)), ids.take(pa.array(d)), pa.array(keys[d]),
                pa.array(start[lead].astype(np.int32)), pa.array(size.astype(np.int32)), *columns,
            ],
            names=PIECE_NAMES,
        )

    index = np.flatnonzero(own)
    breaks = new_doc[index].copy()
    breaks[1:] |= (np.diff(index) != 1) | (anchors[index[1:]] != anchors[index[:-1]])
    yield rows(index, breaks, False)
    index = np.flatnonzero(~own)
    if len(index):
        source = first[index]
        breaks = new_doc[index].copy()
        breaks[0] = True
        breaks[1:] |= (np.diff(index) != 1) | (np.diff(source) != 1) | (doc[source[1:]] != doc[source[:-1]])
        yield rows(index, breaks, True)


PIECE_NAMES = ["anchor", "id", "key", "start", "length", "edges", "src_id", "src_key", "src_start"]


def _cutter(k: int, m: int, sent):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = sent.value
        for batch in batches:
            by = pc.sort_indices(pa.Table.from_batches([batch]), sort_keys=[("id", "ascending"), ("key", "ascending")])
            batch = batch.take(by)
            ids, keys, texts = batch.column(0), batch.column(1).to_numpy(), batch.column(2)
            for first, block in W.blocks(texts, BLOCK_BYTES):
                n = len(block)
                yield from _pieces_of_block(ids.slice(first, n), keys[first : first + n], block, k, m, hot)

    return cut


class _Seen:
    """First occurrences of the edges of one minimizer, across batches."""

    def __init__(self, anchor: int, kind: pa.DataType):
        self.anchor = anchor
        self.edges = np.zeros(0, np.uint64)
        self.full = False  # some edges went on as rows
        self.ids, self.keys, self.starts = pa.array([], kind), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def add(self, edges, ids, keys, starts) -> None:
        edges = np.concatenate([self.edges, edges])
        by = np.argsort(edges, kind="stable")
        self.edges = edges[by]
        self.ids = pa.concat_arrays([self.ids, ids]).take(pa.array(by))
        self.keys = np.concatenate([self.keys, keys])[by]
        self.starts = np.concatenate([self.starts, starts])[by]


def _resolver(group_edges: int):
    """Find the first occurrence of every edge in pieces sorted by minimizer, id, key, start."""

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: _Seen | None = None
        for whole in batches:
            for lo in range(0, whole.num_rows, 1 << 15):
                batch = whole.slice(lo, 1 << 15)
                known = batch.filter(pc.is_null(batch.column(5)))
                if known.num_rows:
                    yield _spans_batch(known.column(1), known.column(2), known.column(3), known.column(4),
                                       known.column(6), known.column(7), known.column(8))
                batch = batch.filter(pc.is_valid(batch.column(5)))
                if not batch.num_rows:
                    continue
                seen, out = _resolve_batch(batch, seen, group_edges)
                yield from out

    return resolve


SPAN_NAMES = ["id", "key", "start", "length", "src_id", "src_key", "src_start", "anchor", "edge"]


def _spans_batch(ids, keys, starts, lengths, src_ids, src_keys, src_starts, anchors=None, edges=None) -> pa.RecordBatch:
    n = len(ids)
    none = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays(
        [ids, keys, starts, lengths, src_ids, src_keys, src_starts,
         none if anchors is None else anchors, none if edges is None else edges],
        names=SPAN_NAMES,
    )


def _resolve_batch(batch: pa.RecordBatch, seen: _Seen | None, group_edges: int):
    anchors = batch.column(0).to_numpy()
    ids, keys = batch.column(1), batch.column(2).to_numpy()
    starts, lengths = batch.column(3).to_numpy(), batch.column(4).to_numpy().astype(np.int64)
    packed = batch.column(5)
    offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
    raw = np.frombuffer(packed.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(-1, EDGE_BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :EDGE_BYTES] = raw
    edges = wide.view("<u8").ravel()
    row = np.repeat(np.arange(len(anchors)), lengths)
    place = W.spans(starts.astype(np.int64), lengths)
    change = np.ones(len(anchors), bool)
    change[1:] = anchors[1:] != anchors[:-1]
    group = np.cumsum(change) - 1
    first = _first_equal(edges | (group[row].astype(np.uint64) << np.uint64(8 * EDGE_BYTES)))
    codes = pc.dictionary_encode(ids, null_encoding="encode").indices.to_numpy()

    def same_place(a, b):
        return (codes[row[a]] == codes[row[b]]) & (keys[row[a]] == keys[row[b]]) & (place[a] == place[b])

    every = np.arange(len(edges))
    repeated = (first != every) & ~same_place(first, every)
    fresh = first == every
    src_row, src_place = row[first], place[first]
    out = []
    carried = np.full(len(edges), -1, np.int64)
    if seen is not None and seen.anchor == anchors[0] and len(seen.edges):
        head = np.flatnonzero(group[row] == 0)
        spot = np.minimum(np.searchsorted(seen.edges, edges[head]), len(seen.edges) - 1)
        hit = seen.edges[spot] == edges[head]
        carried[head[hit]] = spot[hit]
        fresh[head[hit]] = False
        at = np.flatnonzero(carried >= 0)
        c = carried[at]
        equal_id = pc.fill_null(pc.equal(ids.take(pa.array(row[at])), seen.ids.take(pa.array(c))), False).to_numpy(zero_copy_only=False)
        null_both = ids.take(pa.array(row[at])).is_null().to_numpy(zero_copy_only=False) & seen.ids.take(pa.array(c)).is_null().to_numpy(zero_copy_only=False)
        same = (equal_id | null_both) & (keys[row[at]] == seen.keys[c]) & (place[at] == seen.starts[c])
        repeated[at] = ~same
    # Runs of repeated edges whose document and source places advance together.
    index = np.flatnonzero(repeated)
    if len(index):
        c = carried[index]
        from_seen = c >= 0
        src_code = np.where(from_seen, -1, codes[src_row[index]])
        s_place = src_place[index].copy()
        s_key = keys[src_row[index]].copy()
        if from_seen.any():
            s_place[from_seen] = seen.starts[c[from_seen]]
            s_key[from_seen] = seen.keys[c[from_seen]]
            src_code[from_seen] = -1 - pc.dictionary_encode(seen.ids.take(pa.array(c[from_seen])), null_encoding="encode").indices.to_numpy()
        breaks = np.ones(len(index), bool)
        breaks[1:] = (
            (np.diff(index) != 1) | (row[index[1:]] != row[index[:-1]]) | (np.diff(s_place) != 1)
            | (src_code[1:] != src_code[:-1]) | (s_key[1:] != s_key[:-1])
        )
        lead, size = _runs(breaks)
        r = row[index[lead]]
        from_batch = ids.take(pa.array(src_row[index[lead]]))
        if from_seen.any():
            picked = seen.ids.take(pa.array(np.maximum(c[lead], 0)))
            src_ids = pc.if_else(pa.array(from_seen[lead]), picked, from_batch)
        else:
            src_ids = from_batch
        out.append(_spans_batch(
            ids.take(pa.array(r)), pa.array(keys[r]), pa.array(place[index[lead]].astype(np.int32)), pa.array(size.astype(np.int32)),
            src_ids, pa.array(s_key[lead]), pa.array(s_place[lead].astype(np.int32)),
        ))

    def beyond(rest: np.ndarray, anchor: int) -> pa.RecordBatch:
        """Rows of edges unknown to `seen`. Later copies within this batch are
        resolved already; these rows are compared with the others of their kind."""
        r, n = row[rest], len(rest)
        return _spans_batch(
            ids.take(pa.array(r)), pa.array(keys[r]), pa.array(place[rest].astype(np.int32)), pa.array(np.ones(n, np.int32)),
            pa.nulls(n, ids.type), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()),
            pa.array(np.full(n, anchor)), pa.array(edges[rest].view(np.int64)),
        )

    last = anchors[-1]
    if seen is not None and seen.full and seen.anchor == anchors[0] and seen.anchor != last:
        rest = np.flatnonzero(fresh & (group[row] == 0))
        if len(rest):
            out.append(beyond(rest, anchors[0]))
    if seen is None or seen.anchor != last:
        seen = _Seen(last, ids.type)
    mine = np.flatnonzero(fresh & (group[row] == group[-1]))
    room = max(0, group_edges - len(seen.edges))
    kept, rest = mine[:room], mine[room:]
    if len(kept):
        r = row[kept]
        seen.add(edges[kept], ids.take(pa.array(r)), keys[r], place[kept].astype(np.int32))
    if len(rest):
        seen.full = True
        out.append(beyond(rest, last))
    return seen, out


def _spill_over(found: DataFrame) -> DataFrame:
    """Spans of the edges that went beyond GROUP_EDGES: all but the first of each."""
    rest = found.filter(F.col("edge").isNotNull()).select("anchor", "edge", "id", "key", "start")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "start")
    first = freeze(rest.groupBy("anchor", "edge").agg(F.min(place).alias("src"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "edges")
    joined = rest.join(first, ["anchor", "edge"])
    other = ~(F.col("id").eqNullSafe(F.col("src.id")) & (F.col("key") == F.col("src.key")) & (F.col("start") == F.col("src.start")))
    return joined.filter(other).select(
        "id", "key", "start", F.lit(1).alias("length"),
        F.col("src.id").alias("src_id"), F.col("src.key").alias("src_key"), F.col("src.start").alias("src_start"),
    )


def _compact(runs: DataFrame) -> DataFrame:
    """Join runs that continue each other in document and source to long spans."""
    by_place = Window.partitionBy("id", "key").orderBy("start", "length")
    goes_on = (
        F.lag(F.col("start") + F.col("length")).over(by_place).eqNullSafe(F.col("start"))
        & F.lag("src_id").over(by_place).eqNullSafe(F.col("src_id"))
        & F.lag("src_key").over(by_place).eqNullSafe(F.col("src_key"))
        & F.lag(F.col("src_start") + F.col("length")).over(by_place).eqNullSafe(F.col("src_start"))
    )
    so_far = by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = runs.withColumn("new", (~goes_on).cast("int")).withColumn("path", F.sum("new").over(so_far))
    return numbered.groupBy("id", "key", "path").agg(
        F.min("start").alias("start"), F.sum("length").cast("int").alias("length"),
        F.first("src_id").alias("src_id"), F.first("src_key").alias("src_key"), F.min("src_start").alias("src_start"),
    ).drop("path")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(column(id_col).alias("id"), F.hash(column(text_col)).alias("key"), column(text_col).alias("text"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, m: int = M) -> DataFrame:
    """(id, key, start, length, src_id, src_key, src_start): spans of `length`
    consecutive repeated windows, with the place where their words occur first."""
    keyed = _keyed(docs, id_col, text_col)
    kind = keyed.schema["id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(hot_grams(keyed, m, HOT_SHARE))
    pieces = keyed.mapInArrow(
        _cutter(k, m, sent),
        f"anchor long, id {kind}, key int, start int, length int, edges binary, src_id {kind}, src_key int, src_start int",
    )
    dealt = pieces.repartition(partitions_for(docs), "anchor").sortWithinPartitions(
        "anchor", F.col("id").asc_nulls_last(), "key", "start"
    )
    found = freeze_python(
        dealt.mapInArrow(
            _resolver(GROUP_EDGES),
            f"id {kind}, key int, start int, length int, src_id {kind}, src_key int, src_start int, anchor long, edge long",
        ),
        "runs",
    )
    runs = found.filter(F.col("edge").isNull()).drop("anchor", "edge").unionByName(_spill_over(found))
    return _compact(runs)


def _places(spans: pa.Array, words: W.Words, first: str, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and document of the spans listed for each document."""
    size = pc.fill_null(pc.list_value_length(spans), 0).to_numpy().astype(np.int64)
    flat = spans.flatten()
    begin = flat.field(first).to_numpy().astype(np.int64) + np.repeat(words.bounds[:-1], size)
    length = flat.field("length").to_numpy().astype(np.int64) + k - 1
    return begin, length, size


def _digests(words: W.Words, begin: np.ndarray, length: np.ndarray) -> list[bytes]:
    """128-bit digests of the words of spans, joined by one space."""
    joined = W.joined_by_space(words)
    view = memoryview(joined.data)
    at, to = joined.start[begin].tolist(), joined.end[begin + length - 1].tolist()
    return [xxhash.xxh3_128_digest(view[s:e]) for s, e in zip(at, to)]


def _source_digests(k: int):
    @F.arrow_udf("array<binary>")
    def digest(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out, sizes = [], [np.zeros(1, np.int64)]
        for first, block in W.blocks(texts):
            words = W.cut(block)
            begin, length, size = _places(spans.slice(first, len(block)), words, "src_start", k)
            out += _digests(words, begin, length)
            sizes.append(size)
        offsets = np.cumsum(np.concatenate(sizes)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out, pa.binary()))

    return digest


def _with_digests(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, key, start, length, digest): spans with the digest of their source's words.

    Places of a source are made distinct before they are gathered, so a passage
    that many documents repeat is one entry; the join back reads stored tables,
    in which adaptive execution can split such a passage.
    """
    spans = freeze(spans, "spans")
    place = ["src_id", "src_key", "src_start", "length"]
    by_source = spans.select(place).distinct().groupBy("src_id", "src_key").agg(
        F.collect_list(F.struct("src_start", "length")).alias("places")
    )
    sources = _keyed(docs, id_col, text_col).filter("text is not null")
    met = by_source.join(sources, F.col("src_id").eqNullSafe(F.col("id")) & (F.col("src_key") == F.col("key")))
    digested = met.select(
        "src_id", "src_key",
        F.explode(F.arrays_zip("places", _source_digests(k)("text", "places").alias("digest"))).alias("s"),
    )
    known = freeze(
        digested.select(
            F.col("src_id").alias("of_id"), F.col("src_key").alias("of_key"),
            F.col("s.places.src_start").alias("of_start"), F.col("s.places.length").alias("of_length"), "s.digest",
        ),
        "digests",
    )
    same = (
        F.col("src_id").eqNullSafe(F.col("of_id")) & (F.col("src_key") == F.col("of_key"))
        & (F.col("src_start") == F.col("of_start")) & (F.col("length") == F.col("of_length"))
    )
    return spans.join(known, same).select("id", "key", "start", "length", "digest")


def _remover(k: int):
    @F.arrow_udf(RESULT)
    def remove(texts: pa.Array, spans: pa.Array) -> pa.Array:
        kept, n_words, n_removed = [], [], []
        for first, block in W.blocks(texts):
            words = W.cut(block)
            mine = spans.slice(first, len(block))
            begin, length, _ = _places(mine, words, "start", k)
            same = pc.equal(mine.flatten().field("digest"), pa.array(_digests(words, begin, length), pa.binary()))
            same = same.to_numpy(zero_copy_only=False).astype(bool)
            gone = W.covered(begin[same], length[same], len(words.start))
            bounds = np.append(0, np.cumsum(~gone))[words.bounds]
            rest = W.joined_by_space(W.Words(words.data, words.start[~gone], words.end[~gone], bounds))
            some = np.diff(bounds) > 0
            at, to = np.zeros(len(block), np.int64), np.zeros(len(block), np.int64)
            at[some] = rest.start[bounds[:-1][some]]
            to[some] = rest.end[bounds[1:][some] - 1]
            data = rest.data[W.spans(at, to - at)]
            offsets = np.append(0, np.cumsum(to - at)).astype(np.int32)
            kept.append(pa.Array.from_buffers(pa.string(), len(block), [None, pa.py_buffer(offsets), pa.py_buffer(data)]))
            n_words.append(words.counts)
            n_removed.append(words.counts - np.diff(bounds))
        return pa.StructArray.from_arrays(
            [
                pa.concat_arrays([pa.array([], pa.string()), *kept]),
                pa.array(np.concatenate([np.zeros(0, np.int64), *n_words])),
                pa.array(np.concatenate([np.zeros(0, np.int64), *n_removed])),
            ],
            ["text", "n_words", "n_removed"],
        )

    return remove


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, m: int = M) -> DataFrame:
    """`docs` with `kept_text` (the words that stay, joined by one space; null for
    null), `n_words` and `n_removed`."""
    spans = _with_digests(docs, repeated_spans(docs, id_col, text_col, k, m), id_col, text_col, k)
    names, taken = {}, list(docs.columns)
    for name in ("kept_text", "n_words", "n_removed", "span_id", "span_key", "spans", "result", "text_key"):
        names[name] = free_name(name, taken)
        taken.append(names[name])
    by_doc = spans.groupBy("id", "key").agg(F.collect_set(F.struct("start", "length", "digest")).alias(names["spans"])).select(
        F.col("id").alias(names["span_id"]), F.col("key").alias(names["span_key"]), names["spans"]
    )
    joined = docs.withColumn(names["text_key"], F.hash(column(text_col))).join(
        by_doc,
        column(id_col).eqNullSafe(column(names["span_id"])) & (column(names["text_key"]) == column(names["span_key"])),
        "left",
    )
    removed = joined.withColumn(names["result"], _remover(k)(column(text_col), column(names["spans"])))
    result = column(names["result"])
    return removed.select(
        *[column(c) for c in docs.columns],
        F.when(column(text_col).isNotNull(), result["text"]).alias(names["kept_text"]),
        result["n_words"].alias(names["n_words"]), result["n_removed"].alias(names["n_removed"]),
    )
