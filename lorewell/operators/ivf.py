"""Nearest chunks through a cell index: k-means cells and an exact bound.

Index. Spark ML's distributed `KMeans` is fitted on a bounded sample of the
corpus (`SAMPLE_ROWS`, a documented parameter); every row, not only the
sample, is then assigned to its nearest centre and written partitioned by
cell, with each cell's count and radius R (largest distance of a member to
its centre).

Search. For a query q and a cell with centre c, every member x scores
q.x = q.c + q.(x - c) <= q.c + |q| R (Cauchy-Schwarz), whatever the vectors.
Pass 1 scores each query against the members of its `FIRST_PROBE` cells of
highest bound. Pass 2 scores it against every other cell whose bound reaches
the k-th score found in pass 1 (all cells if fewer than k were found). A cell
left out cannot hold a chunk that scores as high, so the result equals the
exact search, ties (to the smaller chunk id) included; only probed cells are
read, through partition pruning of the stored table.

Scoring: queries go to the executors in blocks of about `BLOCK_BYTES`. A task
reads its files of the probed cells batch by batch, finds by the same bound
which queries of the block search a cell, and scores those only. Neither the
vectors nor the (query, cell) pairs are shuffled or listed; a cell of many
files is spread over many tasks. What leaves a task is at most k rows per query.

Edge cases: null vectors are neither indexed nor searched; an empty corpus or
query set gives no rows; ties go to the smaller chunk id; with
`exclude_same_id` a query never finds its own id.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..sources.scratch import freeze, scratch_path
from .knn import SCORE_DECIMALS, Best, Block, _result, matrix, score_batch
from .ranking import top_per_group

SAMPLE_ROWS = 100_000
FIRST_PROBE = 3
# Queries sent at once; queries whose bounds to all cells are held at once.
BLOCK_BYTES = 32 << 20
BOUND_ROWS = 4096
KMEANS_ITERATIONS = 20


@dataclass
class CellIndex:
    path: str
    centres: np.ndarray  # cells x dim, bounded by the number of cells
    radius: np.ndarray
    counts: np.ndarray

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).select("chunk_id", "v", "cell")


def default_cells(n: int) -> int:
    """About the square root of the corpus size: cells and cell sizes grow alike."""
    return max(1, int(round(math.sqrt(max(n, 1)))))


def build(corpus: DataFrame, chunk_id: str = "chunk_id", vector: str = "embedding", cells: int | None = None,
          sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> CellIndex:
    spark = corpus.sparkSession
    rows = corpus.select(F.col(chunk_id).alias("chunk_id"), F.col(vector).cast("array<double>").alias("v")).filter(
        F.col("v").isNotNull()
    )
    rows = freeze(rows, "ivf-rows")
    n = rows.count()
    if n == 0:
        return CellIndex("", np.zeros((0, 1)), np.zeros(0), np.zeros(0, np.int64))
    k = min(cells or default_cells(n), n)
    fraction = min(1.0, 2.0 * sample_rows / n)
    sample = rows.sample(fraction=fraction, seed=seed).limit(sample_rows)
    # The limit leaves one partition; the iterations of the fit run on all of them.
    sample = sample.select(array_to_vector("v").alias("features")).repartition(spark.sparkContext.defaultParallelism)
    model = KMeans(k=k, seed=seed, maxIter=KMEANS_ITERATIONS, featuresCol="features").fit(sample)
    centres = np.array([c for c in model.clusterCenters()], np.float64)
    k = len(centres)
    table = spark.createDataFrame([(i, centres[i].tolist()) for i in range(k)], "cell int, c array<double>")
    assigned = model.setPredictionCol("cell").transform(rows.withColumn("features", array_to_vector("v")))
    assigned = assigned.select("chunk_id", "v", F.col("cell").cast("int").alias("cell"))
    # Distance to the centre, inside the JVM; the centre table has one row per cell.
    dist = F.sqrt(F.aggregate(F.zip_with("v", "c", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    placed = assigned.join(F.broadcast(table), "cell").select("chunk_id", "v", "cell", dist.alias("d"))
    path = scratch_path(spark, "ivf-index")
    # By ranges of cell and id: few files a cell, and a large cell goes to many tasks.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed.repartitionByRange(parts, "cell", "chunk_id").write.partitionBy("cell").parquet(path)
    placed = spark.read.parquet(path)
    stats = {r["cell"]: (r["r"], r["n"]) for r in placed.groupBy("cell").agg(F.max("d").alias("r"), F.count(F.lit(1)).alias("n")).collect()}
    radius = np.array([stats.get(i, (0.0, 0))[0] for i in range(k)], np.float64)
    counts = np.array([stats.get(i, (0.0, 0))[1] for i in range(k)], np.int64)
    return CellIndex(path, centres, radius, counts)


def _bounds(centres: np.ndarray, radius: np.ndarray, q: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(q, axis=1)[:, None]
    return q @ centres.T + norms * radius[None, :]


def _first_cells(index: CellIndex, q: np.ndarray, first: int) -> np.ndarray:
    """The non-empty cells of highest bound of each query, -1 where there are fewer."""
    out = np.full((len(q), min(first, len(index.centres))), -1, np.int32)
    for i in range(0, len(q), BOUND_ROWS):
        bound = _bounds(index.centres, index.radius, q[i : i + BOUND_ROWS])
        bound[:, index.counts == 0] = -np.inf
        head = np.argsort(-bound, axis=1, kind="stable")[:, : out.shape[1]]
        out[i : i + BOUND_ROWS] = np.where(index.counts[head] > 0, head, -1)
    return out


def _reaches(bound: np.ndarray, kth: np.ndarray) -> np.ndarray:
    """Whether a bound may hold a row of a query's k best (any does while kth is missing)."""
    high = np.round(bound, SCORE_DECIMALS) + 10.0**-SCORE_DECIMALS >= kth
    return np.isfinite(bound) & (np.isnan(kth) | high)


def _rest(index: CellIndex, q: np.ndarray, first: np.ndarray, kth: np.ndarray):
    """Per chunk of queries: which other cells each of them has to read."""
    for i in range(0, len(q), BOUND_ROWS):
        reach = _reaches(_bounds(index.centres, index.radius, q[i : i + BOUND_ROWS]), kth[i : i + BOUND_ROWS, None])
        reach[:, index.counts == 0] = False
        head = first[i : i + BOUND_ROWS]
        rows, cols = np.nonzero(head >= 0)
        reach[rows, head[rows, cols]] = False
        yield reach


def _scored(index: CellIndex, block: tuple, probed: np.ndarray, k: int, skip_same: bool, second: bool, spark, out) -> DataFrame:
    """The k best members of the probed cells for each query of a block, by task."""
    shared = spark.sparkContext.broadcast((block, index.centres, index.radius))
    names = out.names

    def run(batches):
        (ids, vectors, first, kth), centres, radius = shared.value
        queries, best = Block(ids, vectors), None
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk_ids, members = batch.column("chunk_id"), matrix(batch.column("v"))
            cells = batch.column("cell").to_numpy(zero_copy_only=False)
            if best is None:
                best = Best(k, chunk_ids.type, ids if skip_same else None, len(ids), distinct=False)
            for cell in np.unique(cells):
                mine = (first == cell).any(1)
                if second:
                    bound = _bounds(centres[cell : cell + 1], radius[cell : cell + 1], vectors)[:, 0]
                    mine = ~mine & _reaches(bound, kth)
                at, among = np.flatnonzero(cells == cell), np.flatnonzero(mine)
                if len(among):
                    score_batch(best, queries, members[at], chunk_ids.take(pa.array(at)), among=among)
        if best is not None:
            yield from _result(best, ids, names).to_batches()

    members = index.table(spark).filter(F.col("cell").isin([int(c) for c in probed]))
    return members.select("chunk_id", "v", "cell").mapInArrow(run, out)


def _block(queries: DataFrame) -> tuple[pa.Array, np.ndarray]:
    table = queries.select("query_id", "v").toArrow()
    return table["query_id"].combine_chunks(), matrix(table["v"])


def _schema(queries: DataFrame, chunk_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("chunk_id", chunk_type),
        T.StructField("score", T.DoubleType()),
    ])


def _blocks(queries: DataFrame) -> tuple[DataFrame, int]:
    """The queries with the number of their block, of about BLOCK_BYTES each."""
    size = queries.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"),
        F.max(F.octet_length(F.col("query_id").cast("string"))).alias("id_bytes"),
    ).first()
    n = max(1, math.ceil(size["n"] * (8 * (size["dim"] or 1) + (size["id_bytes"] or 0)) / BLOCK_BYTES))
    return freeze(queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n))), "ivf-queries"), n


def nearest(index: CellIndex, queries: DataFrame, k: int, query_id: str = "query_id",
            query_vector: str = "query_vector", exclude_same_id: bool = False,
            first_probe: int = FIRST_PROBE) -> DataFrame:
    """`(query_id, chunk_id, score, rank)`, equal to the exact search."""
    spark = queries.sparkSession
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).cast("array<double>").alias("v")).filter(
        F.col("v").isNotNull()
    )
    order = [F.col("score").desc(), F.col("chunk_id").asc()]
    if len(index.centres) == 0:
        return spark.createDataFrame([], f"query_id {q.schema['query_id'].dataType.simpleString()}, chunk_id long, score double, rank int")
    out = _schema(q, index.table(spark).schema["chunk_id"].dataType)
    q, n_blocks = _blocks(q)
    found = None
    for b in range(n_blocks):
        mine = q.filter(F.col("block") == b)
        best = freeze(_nearest_block(index, mine, k, exclude_same_id, first_probe, order, out), "ivf-best")
        found = best if found is None else found.unionByName(best)
    return found


def _nearest_block(index, mine, k, exclude_same_id, first_probe, order, out) -> DataFrame:
    spark = mine.sparkSession
    ids, vectors = _block(mine)
    if not len(ids):
        return spark.createDataFrame([], out).withColumn("rank", F.lit(0))
    first = _first_cells(index, vectors, first_probe)
    none = np.full(len(ids), np.nan)
    probed = np.unique(first[first >= 0])
    scored = _scored(index, (ids, vectors, first, none), probed, k, exclude_same_id, False, spark, out)
    held = freeze(top_per_group(scored, ["query_id"], order, k, "rank"), "ivf-first").drop("rank")
    kth = _floors(held, ids, k)
    probed = np.zeros(len(index.centres), bool)
    for reach in _rest(index, vectors, first, kth):
        probed |= reach.any(0)
    second = _scored(index, (ids, vectors, first, kth), np.flatnonzero(probed), k, exclude_same_id, True, spark, out)
    return top_per_group(held.unionByName(second), ["query_id"], order, k, "rank")


def _floors(held: DataFrame, ids: pa.Array, k: int) -> np.ndarray:
    """The k-th score of each query of a block, NaN where fewer were found."""
    table = held.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth")).toArrow()
    kth = table["kth"].cast(pa.float64()).fill_null(np.nan).to_numpy()
    at = pc.index_in(ids, value_set=table["query_id"].combine_chunks()).fill_null(-1).to_numpy(zero_copy_only=False)
    return np.where(at >= 0, np.append(kth, np.nan)[at], np.nan)


def scored_pairs(index: CellIndex, queries: DataFrame, k: int, query_vector: str = "query_vector",
                 first_probe: int = FIRST_PROBE, query_id: str = "query_id") -> int:
    """How many (query, chunk) scores a search computes (for the share of all pairs)."""
    spark = queries.sparkSession
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).cast("array<double>").alias("v")).filter(
        F.col("v").isNotNull()
    )
    out = _schema(q, index.table(spark).schema["chunk_id"].dataType)
    q, n_blocks = _blocks(q)
    order = [F.col("score").desc(), F.col("chunk_id").asc()]
    total = 0
    for b in range(n_blocks):
        ids, vectors = _block(q.filter(F.col("block") == b))
        if not len(ids):
            continue
        first = _first_cells(index, vectors, first_probe)
        probed = np.unique(first[first >= 0])
        scored = _scored(index, (ids, vectors, first, np.full(len(ids), np.nan)), probed, k, True, False, spark, out)
        kth = _floors(top_per_group(scored, ["query_id"], order, k, "rank"), ids, k)
        total += int(index.counts[first[first >= 0]].sum())
        total += sum(int((reach @ index.counts).sum()) for reach in _rest(index, vectors, first, kth))
    return total
