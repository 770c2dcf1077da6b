"""Nearest chunks of each query by dot product.

A task scores its share of the corpus against a block of queries by matrix
products in single precision; pairs that may still reach a query's k best are
scored again in double precision, and the k best per query are kept. Only those leave the
task, so neither the pairs nor a query's candidates are ever gathered. An exact search
starts from a floor per query, taken from a bounded sample of the corpus; rows
below it cannot be among the k best. Tables with repeated chunk ids are searched
without, as copies of an id take places there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from ..sources.scratch import freeze, freeze_python
from .ranking import top_per_group

# Queries up to this size are sent to every executor at once; larger sets go in
# blocks of the second size.
BROADCAST_BYTES = 64 << 20
GROUP_BYTES = 64 << 20
# Queries sent for one reading of the corpus, in blocks.
PASS_BYTES = 64 << 20
# Corpus rows of a part; scores of a part held at once, in single precision and
# in double; pairs whose vectors are gathered at once.
PART_ROWS = 2048
SCORE_CELLS = 2 << 20
WHOLE_CELLS = 1 << 20
PAIR_ROWS = 8192
# Corpus rows, and bytes of them, whose scores give every query its first floor.
SAMPLE_ROWS = 1 << 13
SAMPLE_BYTES = 16 << 20
# Rows kept before the first cut to k per query.
PRUNE_ROWS = 1 << 14
# Products of lengths up to this are safe in single precision.
FLOAT_SAFE = 1e30
# Scores are rounded, so ranks do not depend on the order of summation.
SCORE_DECIMALS = 9


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a column as rows: in single precision if they are stored so, else in double."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    flat = flat if flat.dtype == np.float32 else flat.astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def double(vectors: np.ndarray) -> np.ndarray:
    return vectors.astype(np.float64, copy=False)


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Euclidean lengths, summed in double precision without a copy of the vectors."""
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64))


class Planes:
    """Signs against random hyperplanes: one bucket number per table."""

    def __init__(self, dim: int, tables: int, bits: int, seed: int):
        self.normals = np.random.default_rng(seed).standard_normal((tables, dim, bits))
        self.weights = 1 << np.arange(bits, dtype=np.int64)
        self.kind = np.min_scalar_type((1 << bits) - 1)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        vectors = double(vectors)
        return np.stack([(((vectors @ n) > 0) @ self.weights).astype(self.kind) for n in self.normals])


class Best:
    """Running k best rows per query.

    `floor` is the score of a query's k-th best row so far: a lower one cannot
    enter any more. With `distinct`, a pair that was offered twice counts once.
    """

    def __init__(self, k: int, id_type: pa.DataType, skip_same: pa.Array | None, n_queries: int, distinct: bool = True):
        self.k, self.id_type, self.skip_same, self.distinct = k, id_type, skip_same, distinct
        self.rows: list[pa.Table] = []
        self.held, self.prune_at = 0, 0
        self.floor = np.full(n_queries, -np.inf)
        # One more than k, because the query's own row may be among them.
        self.keep = k + (skip_same is not None)

    def take(self, query: np.ndarray, at: np.ndarray, score: np.ndarray, ids: pa.Array) -> None:
        """Rows (query, ids[at], score); queries' own rows are left out."""
        found = pa.table({"q": query, "id": ids.take(pa.array(at)), "score": score})
        if self.skip_same is not None:
            other = pc.not_equal(self.skip_same.take(found["q"].combine_chunks()), found["id"])
            found = found.filter(other if self.distinct else other.fill_null(True))
        self.rows.append(found)
        self.held += found.num_rows
        if self.held > self.prune_at:
            self.prune()

    def offer(self, scores: np.ndarray, query_index: np.ndarray, ids: pa.Array, able: np.ndarray | None = None) -> None:
        """Take the rows of a score block that can still be among the k best.

        `ids` are in ascending order; of equal scores at the cut, those of the
        first ids stay. `able` marks the pairs that count at all.
        """
        n = scores.shape[1]
        if n > self.keep:
            cut = np.partition(scores, n - self.keep, axis=1)[:, n - self.keep, None]
            take = scores > cut
            tied = scores == cut
            fresh = np.ones(n, bool)
            if n > 1:
                fresh[1:] = pc.not_equal(ids[1:], ids[:-1]).fill_null(True).to_numpy(zero_copy_only=False)
            if not self.distinct:
                fresh[:] = True
            take |= tied & (np.cumsum(tied & fresh, axis=1, dtype=np.int32) <= self.keep)
        else:
            take = np.ones(scores.shape, bool)
        take &= ~(scores < self.floor[query_index][:, None])
        if able is not None:
            take &= able
        row, col = np.nonzero(take)
        self.take(query_index[row], col, scores[row, col], ids)

    def prune(self) -> pa.Table:
        table = pa.concat_tables(self.rows) if self.rows else pa.table(
            {"q": pa.array([], pa.int64()), "id": pa.array([], self.id_type), "score": pa.array([], pa.float64())}
        )
        table = table.sort_by([("q", "ascending"), ("score", "descending"), ("id", "ascending")])
        q = table["q"].to_numpy()
        if len(q):
            if self.distinct:
                # A pair may be found through several tables; equal rows are neighbours.
                ids = table["id"].combine_chunks()
                same = np.zeros(len(q), bool)
                same[1:] = (q[1:] == q[:-1]) & pc.equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False)
                table = table.filter(pa.array(~same))
                q = table["q"].to_numpy()
            place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
            last = place == self.k - 1
            self.floor[q[last]] = table["score"].to_numpy()[last]
            table = table.filter(pa.array(place < self.k))
        self.rows, self.held = [table], table.num_rows
        self.prune_at = max(PRUNE_ROWS, self.held + self.held // 2)
        return table


@dataclass
class Block:
    """Queries that are scored together, with what the score bounds need.

    Scores are first taken in single precision. A rounded dot product is off by
    at most `slack` times both lengths, whatever the order of summation, so only
    pairs within that of a query's floor are scored in double precision.
    """

    ids: pa.Array
    vectors: np.ndarray
    codes: np.ndarray | None = None

    def __post_init__(self):
        self.single = self.vectors.astype(np.float32, copy=False)
        self.norms = lengths(self.vectors)
        self.slack = 1.1 * (self.vectors.shape[1] + 4) * 2.0**-24


def score_batch(
    best: Best, block: Block, corpus: np.ndarray, ids: pa.Array, planes: Planes | None = None, among: np.ndarray | None = None,
) -> None:
    """Offer all scores of a corpus batch, or those of matching buckets only.

    `among` are the queries that search this batch (default: all).
    """
    _score_rows(best, block, *_by_id(corpus, ids, planes), among)


def _by_id(corpus: np.ndarray, ids: pa.Array, planes: Planes | None) -> tuple:
    """Vectors, ids and buckets of a corpus batch in order of id."""
    order = pc.sort_indices(ids)
    ids, corpus = ids.take(order), corpus[order.to_numpy()]
    return corpus, ids, planes.buckets(corpus) if planes else None


def _score_rows(best, block, corpus, ids, codes, among=None) -> None:
    queries = np.arange(len(block.vectors)) if among is None else among
    if codes is not None and _matches(block.codes, codes) < len(block.vectors) * len(corpus):
        _score_buckets(best, block, corpus, ids, codes)
        return
    if codes is not None and best.distinct:
        once = _once(corpus, ids)
        ids, corpus, codes = ids.take(pa.array(once)), corpus[once], codes[:, once]
    for start in range(0, len(corpus), PART_ROWS):
        part, part_ids = corpus[start : start + PART_ROWS], ids[start : start + PART_ROWS]
        part_codes = codes[:, start : start + PART_ROWS] if codes is not None else None
        single, reach = part.astype(np.float32, copy=False), lengths(part).max()
        step = max(1, SCORE_CELLS // len(part))
        for first in range(0, len(queries), step):
            _score_part(best, block, queries[first : first + step], part, single, reach, part_ids, part_codes)


def _once(corpus: np.ndarray, ids: pa.Array) -> np.ndarray:
    """Rows of a batch in order of id, without repeats of both id and vector."""
    same = np.zeros(len(corpus) + 1, bool)
    same[1:-1] = pc.equal(ids[1:], ids[:-1]).fill_null(False).to_numpy(zero_copy_only=False)
    repeated = np.flatnonzero(same[1:] | same[:-1])
    keep = np.ones(len(corpus), bool)
    if len(repeated):
        group = np.cumsum(~same[:-1])[repeated]
        _, first = np.unique(np.column_stack([group, corpus[repeated]]), axis=0, return_index=True)
        keep[repeated] = False
        keep[repeated[first]] = True
    return np.flatnonzero(keep)


def _score_part(best, block, q, part, single, reach, ids, codes) -> None:
    """Queries `q` against one part of the corpus."""
    margin = block.slack * block.norms[q] * reach + 2 * 10.0**-SCORE_DECIMALS
    with np.errstate(invalid="ignore", over="ignore"):
        least = np.nextafter((best.floor[q] - margin).astype(np.float32), np.float32(-np.inf))
    rough = np.isfinite(least) & (block.norms[q] * reach < FLOAT_SAFE)
    whole = q[~rough]
    if rough.any():
        some = q if rough.all() else q[rough]
        near = _marked(block.single[some] @ single.T >= least[rough, None])
        row, col = np.divmod(near, len(part))
        # Queries with many rows near the floor (ties) are scored whole.
        many = np.bincount(row, minlength=len(some)) > 4 * best.keep + 64
        whole = np.concatenate([whole, some[many]])
        if many.any():
            row, col = row[~many[row]], col[~many[row]]
        for i in range(0, len(row), PAIR_ROWS):
            r, c = some[row[i : i + PAIR_ROWS]], col[i : i + PAIR_ROWS]
            if codes is not None:
                match = (block.codes[:, r] == codes[:, c]).any(0)
                r, c = r[match], c[match]
            score = np.round(np.einsum("ij,ij->i", double(block.vectors[r]), double(part[c])), SCORE_DECIMALS)
            high = score >= best.floor[r]
            best.take(r[high], c[high], score[high], ids)
    step = max(1, WHOLE_CELLS // len(part))
    part = double(part) if len(whole) else part
    for i in range(0, len(whole), step):
        r = whole[i : i + step]
        scores = np.round(double(block.vectors[r]) @ part.T, SCORE_DECIMALS)
        able = None
        if codes is not None:
            able = np.zeros(scores.shape, bool)
            for mine, theirs in zip(block.codes, codes):
                able |= mine[r][:, None] == theirs[None, :]
            scores[~able] = -np.inf
        best.offer(scores, r, ids, able)


def _marked(mask: np.ndarray) -> np.ndarray:
    """Flat positions of the set cells of a sparse mask, ascending; looks at eight cells at a time."""
    flat = mask.ravel()
    if flat.size % 8:
        return np.flatnonzero(flat)
    at = (np.flatnonzero(flat.view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return at[flat[at]]


def _matches(q_codes: np.ndarray, c_codes: np.ndarray) -> int:
    """Pairs that share a bucket, counted once in each table."""
    total = 0
    for mine, theirs in zip(q_codes, c_codes):
        n = 1 + max(int(mine.max(initial=0)), int(theirs.max(initial=0)))
        total += int(np.bincount(mine, minlength=n) @ np.bincount(theirs, minlength=n))
    return total


def _score_buckets(best, block, corpus, ids, codes) -> None:
    """Bucket by bucket: for buckets so small that this is less than all pairs."""
    for mine, theirs in zip(block.codes, codes):
        q_order, c_order = np.argsort(mine, kind="stable"), np.argsort(theirs, kind="stable")
        q_sorted, c_sorted = mine[q_order], theirs[c_order]
        for code in np.intersect1d(q_sorted, c_sorted):
            q_at = q_order[slice(*np.searchsorted(q_sorted, [int(code), int(code) + 1]))]
            c_at = c_order[slice(*np.searchsorted(c_sorted, [int(code), int(code) + 1]))]
            part, part_ids = double(corpus[c_at]), ids.take(pa.array(c_at))
            step = max(1, WHOLE_CELLS // len(c_at))
            for i in range(0, len(q_at), step):
                r = q_at[i : i + step]
                best.offer(np.round(double(block.vectors[r]) @ part.T, SCORE_DECIMALS), r, part_ids)


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    chunk_id: str = "chunk_id",
    vector: str = "embedding",
    exclude_same_id: bool = False,
    lsh: tuple[int, int] | None = None,
    seed: int = 17,
    broadcast_bytes: int = BROADCAST_BYTES,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """`(query_id, chunk_id, score, rank)` of the `k` nearest chunks per query.

    Exact unless `lsh=(tables, bits)` limits the scored pairs to those sharing
    a hyperplane bucket in some table. Ties go to the smaller chunk id.
    Counts the queries when the plan is built, to choose how they travel.
    """
    left = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("v"))
    left = left.filter(F.col("v").isNotNull())
    right = corpus.select(F.col(chunk_id).alias("chunk_id"), F.col(vector).alias("v"))
    right = right.filter(F.col("v").isNotNull())
    id_bytes = F.octet_length(F.col("query_id").cast("string"))
    size = left.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"), F.max(id_bytes).alias("id_bytes")
    ).first()
    out = T.StructType(
        [
            T.StructField("query_id", left.schema["query_id"].dataType),
            T.StructField("chunk_id", right.schema["chunk_id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    bytes_per_vector = 8 * (size["dim"] or 1) + (size["id_bytes"] or 0)
    planes = Planes(size["dim"] or 1, *lsh, seed) if lsh else None
    if not planes and not _repeats(right):
        rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // bytes_per_vector))
        left = with_floors(left, right, k + exclude_same_id, rows)
    if size["n"] * bytes_per_vector <= broadcast_bytes:
        found = _by_broadcast(left, right, k, out, planes, exclude_same_id)
    else:
        n_blocks = math.ceil(size["n"] * bytes_per_vector / group_bytes)
        found = _by_blocks(left, right, k, out, planes, exclude_same_id, n_blocks, group_bytes)
    order = [F.col("score").desc(), F.col("chunk_id").asc()]
    return top_per_group(found, ["query_id"], order, k, "rank")


def _repeats(right: DataFrame) -> bool:
    """Whether a chunk id comes more than once; such tables are searched without first floors."""
    several = right.filter(F.col("chunk_id").isNotNull()).groupBy("chunk_id").count().filter("count > 1")
    return bool(several.select(F.lit(1)).take(1))


def with_floors(left: DataFrame, right: DataFrame, keep: int, rows: int) -> DataFrame:
    """The queries with `floor`, a score that at least `keep` rows of the corpus reach.

    It is the `keep`-th best score among at most `rows` corpus rows, whose ids must differ, less the bound
    of its rounding. Every corpus row is still scored: a search only starts with this floor instead of none.
    """
    picked = right.filter(F.col("chunk_id").isNotNull()).orderBy(F.xxhash64("chunk_id")).limit(rows)
    table = picked.select("v").toArrow()
    sample = matrix(table["v"])
    sample = sample[lengths(sample) < FLOAT_SAFE].astype(np.float32)
    shared = left.sparkSession.sparkContext.broadcast(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries = matrix(batch.column("v")) if batch.num_rows else np.zeros((0, 1))
            yield batch.append_column("floor", pa.array(first_floors(queries, shared.value, keep)))

    return left.mapInArrow(run, T.StructType([*left.schema, T.StructField("floor", T.DoubleType())]))


def first_floors(queries: np.ndarray, sample: np.ndarray, keep: int) -> np.ndarray:
    floor = np.full(len(queries), -np.inf)
    if len(sample) < keep or not len(queries):
        return floor
    reach = lengths(sample).max()
    step = max(1, SCORE_CELLS // len(sample))
    for i in range(0, len(queries), step):
        block = Block(None, queries[i : i + step])
        with np.errstate(invalid="ignore", over="ignore"):
            scores = np.partition(block.single @ sample.T, len(sample) - keep, axis=1)[:, len(sample) - keep]
            least = scores - (block.slack * block.norms * reach + 2 * 10.0**-SCORE_DECIMALS)
            safe = np.isfinite(least) & (block.norms * reach < FLOAT_SAFE)
        floor[i : i + step] = np.where(safe, least, -np.inf)
    return floor


def _result(best: Best, query_ids: pa.Array, names: Sequence[str]) -> pa.Table:
    kept = best.prune()
    return pa.table(
        [query_ids.take(kept["q"].combine_chunks()), kept["id"], kept["score"]], names=list(names)
    )


def _by_broadcast(left, right, k, out, planes, skip_same) -> DataFrame:
    """Every corpus task gets all queries; their size was checked by the caller."""
    return _search([_shared(left, planes)], right, k, out, planes, skip_same)


def _shared(left: DataFrame, planes: Planes | None):
    """The queries of a frame, sent to the executors."""
    table = left.toArrow()
    query_ids, queries = table["query_id"].combine_chunks(), matrix(table["v"])
    codes = planes.buckets(queries) if planes and len(queries) else None
    return left.sparkSession.sparkContext.broadcast((query_ids, queries, codes, *_floors(table)))


def _floors(table: pa.Table) -> list[np.ndarray]:
    return [table["floor"].to_numpy()] if "floor" in table.column_names else []


def _search(blocks: list, right: DataFrame, k: int, out, planes, skip_same) -> DataFrame:
    """The k best rows of each corpus task for the queries of every block.

    A task goes through its share of the corpus once, one batch after the other, each against all
    blocks; it holds the blocks, their best rows so far and one batch, never its share.
    """
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches: list[tuple[Block, Best]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk_ids = batch.column("chunk_id")
            if not searches:
                for ids, vectors, codes, *floors in (shared.value for shared in blocks):
                    if len(ids):
                        best = Best(k, chunk_ids.type, ids if skip_same else None, len(ids))
                        if floors:
                            best.floor = floors[0].copy()
                        searches.append((Block(ids, vectors, codes), best))
            rows = _by_id(matrix(batch.column("v")), chunk_ids, planes)
            for block, best in searches:
                _score_rows(best, block, *rows)
        while searches:
            block, best = searches.pop(0)
            yield from _result(best, block.ids, names).to_batches()

    return right.mapInArrow(run, out)


def _by_blocks(left, right, k, out, planes, skip_same, n_blocks: int, group_bytes: int) -> DataFrame:
    """One broadcast search per block of queries; the corpus is read again, never copied.

    Blocks come from a hash of the id, so they are even whatever the data. A
    reading of the corpus serves as many blocks as fit PASS_BYTES; its winners
    are stored before the next blocks are sent. A task works on one block at a time.
    """
    stored = freeze(left.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks))), "query-blocks")
    order = [F.col("score").desc(), F.col("chunk_id").asc()]
    found = None
    for first, last in passes(n_blocks, group_bytes):
        mine = stored.filter((F.col("block") >= first) & (F.col("block") < last))
        shared = _shared_blocks(mine, first, last, planes)
        best = freeze_python(top_per_group(_search(shared, right, k, out, planes, skip_same), ["query_id"], order, k, "_r").drop("_r"), "nearest")
        for one in shared:
            one.destroy()
        found = best if found is None else found.unionByName(best)
    return found


def passes(n_blocks: int, group_bytes: int) -> list[tuple[int, int]]:
    """Ranges of blocks, each for one reading of the corpus."""
    each = max(1, PASS_BYTES // max(1, group_bytes))
    return [(i, min(i + each, n_blocks)) for i in range(0, n_blocks, each)]


def _shared_blocks(mine: DataFrame, first: int, last: int, planes: Planes | None) -> list:
    """The blocks of one pass (at most PASS_BYTES of queries, or one block), each sent by itself."""
    table = mine.toArrow()
    block = table["block"].to_numpy()
    sc, out = mine.sparkSession.sparkContext, []
    for b in range(first, last):
        part = table.filter(pa.array(block == b))
        ids, queries = part["query_id"].combine_chunks(), matrix(part["v"])
        codes = planes.buckets(queries) if planes and len(queries) else None
        out.append(sc.broadcast((ids, queries, codes, *_floors(part))))
    return out
