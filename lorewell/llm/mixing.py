"""Mixing sources to target weights by cube-method balanced sampling.

Each source gets a target number of words. A document enters the mix as often
as its source's ratio of target to size says: the whole part for sure, the
fraction with that probability. The fractions are decided by the cube method:
within bounded blocks of one source, three undecided documents at a time move
along the null-space of the constraints (document count, word total) until one
of them is in or out. Totals stay exact during this flight; each block leaves at
most two documents undecided. These meet in larger blocks until each source has
one block, where the last two are landed at the least word error.

Blocks are sets of hashed rows sorted by content, so results depend on the rows
and not on their layout, and a retried task decides alike. A block is streamed:
only undecided rows are held. Equal rows are separate units that may be decided
differently. Null sources form a source of their own, ranked last; a null size
counts as 0; a source without words has target 0; empty tables give empty results.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .scratch import column, free_name, freeze, freeze_python, partitions_for

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
BLOCK_UNITS = 4096
SEED = 42
EDGE = 1e-9


def ranked_sources(docs: DataFrame, source_col: str, size_col: str) -> DataFrame:
    """(source, n_docs, source_size, rank): ranks by code point, null last, from 0.

    Sources are range-partitioned; ranks are numbers within a range plus the
    sizes of the ranges before, so no task needs all sources.
    """
    totals = docs.groupBy(column(source_col).cast("string").alias("source")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum(F.coalesce(column(size_col), F.lit(0)).cast("long")), F.lit(0)).alias("source_size"),
    )
    order = [F.col("source").isNull(), F.col("source")]
    ranges = totals.repartitionByRange(partitions_for(docs), *order).withColumn("range", F.spark_partition_id())
    numbered = freeze(
        ranges.withColumn("number", F.row_number().over(Window.partitionBy("range").orderBy(*order))), "sources"
    )
    sizes = numbered.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return numbered.join(offsets, "range").select(
        "source", "n_docs", "source_size", (F.col("offset") + F.col("number") - 1).alias("rank")
    )


def with_targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """`sources` with `target`: shares by weight of `share` times all sizes, none above
    `cap` times its source. What a source cannot take goes to the others by weight.

    Only totals come to the driver, once per round of capping.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = freeze(
        sources.withColumns({"weight": weight, "most": F.col("source_size") * F.lit(float(cap))}), "weights"
    )
    total, all_weights, most = sources.agg(F.sum("source_size"), F.sum("weight"), F.sum("most")).first()
    wanted = min(share * (total or 0), most or 0.0)
    level, capped = (wanted / all_weights if all_weights else 0.0), -1
    while True:
        full = F.col("most") <= F.col("weight") * F.lit(level)
        n, taken, left = sources.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == capped or not left:
            break
        capped, level = n, (wanted - taken) / left
    return sources.withColumn("target", F.least("most", F.col("weight") * F.lit(level)))


class Flight:
    """The undecided units of one block: at most two between steps."""

    def __init__(self, key: tuple, seed: int):
        self.draw = random.Random(repr((seed, key)))
        self.units: list[list] = []  # [row, probability, size]

    def add(self, row: int, p: float, size: float) -> Iterator[tuple[int, int]]:
        self.units.append([row, p, size])
        while len(self.units) > 2 or (len(self.units) == 2 and self.units[0][2] == self.units[1][2]):
            yield from self._step()

    def _step(self) -> list[tuple[int, int]]:
        """Move along a vector that keeps the sums of p and of p * size."""
        (_, pa_, za), (_, pb, zb) = self.units[:2]
        if za == zb:
            move = [1.0, -1.0]
        else:
            zc = self.units[2][2]
            scale = max(abs(zc - zb), abs(za - zc), abs(zb - za))
            move = [(zc - zb) / scale, (za - zc) / scale, (zb - za) / scale]
        up = min((1 - u[1]) / m if m > 0 else u[1] / -m for u, m in zip(self.units, move) if m)
        down = min(u[1] / m if m > 0 else (1 - u[1]) / -m for u, m in zip(self.units, move) if m)
        step = up if self.draw.random() * (up + down) < down else -down
        for unit, m in zip(self.units, move):
            unit[1] += step * m
        done = [u for u in self.units if u[1] <= EDGE or u[1] >= 1 - EDGE]
        self.units = [u for u in self.units if EDGE < u[1] < 1 - EDGE]
        return [(u[0], round(u[1])) for u in done]

    def land(self) -> list[tuple[int, int]]:
        """Round the last units so that the word total errs least, then the count."""
        choices = [[]]
        for _ in self.units:
            choices = [[*c, v] for c in choices for v in (0, 1)]

        def error(choice):
            moved = [v - u[1] for v, u in zip(choice, self.units)]
            return (abs(sum(m * u[2] for m, u in zip(moved, self.units))), abs(sum(moved)), choice)

        best = min(choices, key=error)
        done, self.units = [(u[0], v) for u, v in zip(self.units, best)], []
        return done


def _fly(keys: Sequence[str], p_col: str, size_col: str, seed: int, land: bool):
    """Run the flight over batches sorted by block; the probability column then
    holds 0, 1 or what is still undecided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        flight, key = None, None
        for batch in batches:
            n_held = 0
            if held is not None and held.num_rows:
                n_held = held.num_rows
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
                for i, unit in enumerate(flight.units):
                    unit[0] = i
            at = batch.schema.get_field_index(p_col)
            p = batch.column(at).to_numpy(zero_copy_only=False).copy()
            size = batch.column(batch.schema.get_field_index(size_col)).to_numpy(zero_copy_only=False)
            labels = list(zip(*[batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]))
            ready = np.ones(batch.num_rows, bool)
            ready[:n_held] = False
            for row in range(n_held, batch.num_rows):
                if labels[row] != key:
                    _finish(flight, p, ready, land)
                    key, flight = labels[row], Flight(labels[row], seed)
                if EDGE < p[row] < 1 - EDGE:
                    ready[row] = False
                    for i, v in flight.add(row, float(p[row]), float(size[row])):
                        p[i], ready[i] = v, True
            for unit in flight.units:
                p[unit[0]] = unit[1]
            out = batch.set_column(at, batch.schema.field(at), pa.array(p))
            held = out.take(pa.array(np.array([u[0] for u in flight.units], np.int64)))
            yield out.filter(pa.array(ready))
        if held is not None and held.num_rows:
            if land:
                p = np.zeros(held.num_rows)
                for i, unit in enumerate(flight.units):
                    unit[0] = i
                for i, v in flight.land():
                    p[i] = v
                at = held.schema.get_field_index(p_col)
                held = held.set_column(at, held.schema.field(at), pa.array(p))
            yield held

    return run


def _finish(flight: Flight | None, p: np.ndarray, ready: np.ndarray, land: bool) -> None:
    """Give out what a finished block still holds."""
    if flight is None:
        return
    for row, value, _ in flight.units:
        p[row], ready[row] = value, True
    if land:
        for row, value in flight.land():
            p[row] = value
    flight.units = []


def mix(
    docs: DataFrame, size_col: str, source_col: str = "source", weights: Sequence[float] = WEIGHTS,
    share: float = SHARE, cap: float = CAP, seed: int = SEED, block_units: int = BLOCK_UNITS,
) -> DataFrame:
    """`docs` with `source_size`, `target` (of its source) and `repeats`, how often
    the mix takes the document."""
    taken_names: list[str] = list(docs.columns)

    def name(wanted: str) -> str:
        taken_names.append(free_name(wanted, taken_names))
        return taken_names[-1]

    size, target, repeats, whole, p, block, order, key = (
        name(n) for n in ("source_size", "target", "repeats", "whole", "chance", "block", "order", "source_key")
    )
    words = name("words")
    plan = with_targets(ranked_sources(docs, source_col, size_col), weights, share, cap).select(
        F.col("source").alias(key), F.col("source_size").alias(size), F.col("target").alias(target), "n_docs",
    )
    plan = freeze(plan.withColumnRenamed("n_docs", block), "targets")
    simple = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.BinaryType)
    hashed = [column(f.name).cast("string") for f in docs.schema.fields if isinstance(f.dataType, simple)]
    ratio = F.when(column(size) > 0, column(target) / column(size)).otherwise(0.0)
    units = docs.join(plan, column(source_col).cast("string").eqNullSafe(column(key)))
    units = units.withColumns({
        words: F.coalesce(column(size_col), F.lit(0)).cast("double"),
        whole: F.floor(ratio + EDGE).cast("int"),
        order: F.xxhash64(F.lit(seed), *hashed),
    })
    units = units.withColumn(p, F.greatest(F.lit(0.0), ratio - column(whole)))
    units = units.withColumn(
        block, F.pmod(F.xxhash64(order), F.ceil(column(block) / F.lit(block_units)).cast("long"))
    )

    def fly(rows: DataFrame, land: bool) -> DataFrame:
        dealt = rows.repartition(partitions_for(docs), column(key), column(block)).sortWithinPartitions(
            column(key), column(block), column(order)
        )
        return freeze_python(dealt.mapInArrow(_fly((key, block), p, words, seed, land), dealt.schema), "flight")

    done = []
    rows, land = units, False
    while True:
        flown = fly(rows, land)
        open_ = (column(p) > EDGE) & (column(p) < 1 - EDGE)
        done.append(flown.filter(~open_))
        if land:
            break
        rows = flown.filter(open_)
        left = rows.groupBy(column(key)).agg(F.ceil(F.count(F.lit(1)) / F.lit(block_units)).alias("n"))
        most = left.agg(F.max("n")).first()[0] or 1
        land = most <= 1
        # The number of blocks is the same for all sources, which keeps each within block_units.
        rows = rows.withColumn(block, F.pmod(F.xxhash64(order, F.lit(len(done))), F.lit(most)))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    out = out.withColumn(repeats, column(whole) + F.round(column(p)).cast("int"))
    return out.select(*[column(c) for c in (*docs.columns, size, target, repeats)])


def materialise(mixed: DataFrame, columns: Sequence[str], repeats_col: str = "repeats") -> DataFrame:
    """The mix itself: each row as often as it is taken, with the given columns."""
    times = F.explode(F.array_repeat(F.lit(0), column(repeats_col)))
    once = free_name("copy", mixed.columns)
    return mixed.withColumn(once, times).select(*[column(c) for c in columns])
