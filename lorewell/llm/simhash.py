"""SimHash near-duplicates by exact tiled comparison.

Fingerprints of equal value are one node. Nodes are tiled by the set-bit counts
of their four 16-bit quarters: two fingerprints within the radius differ in
these counts by at most the radius in sum, so all other pairs of tiles are
skipped and no link is lost. A tile is compared with its own and the neighbour
tiles' fingerprints by exclusive-or and bit count in numpy blocks; what leaves a
task is a spanning forest of the links, at most one edge a compared row, never
all pairs. Components are then joined by star contraction.

A null or blank text has fingerprint zero and links like any other. Equal rows
share a component. Rows with a null id link as well; a component without any id
has a null component id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from . import words as W
from .components import star_components
from .scratch import column, free_name, freeze, freeze_python, partitions_for
from .xxh64 import xxh64

SHINGLE = 3
RADIUS = 2
SEED = 42
QUARTERS = 4
CELLS = 17**QUARTERS
# Fingerprints of one side of a tile, and rows of a compared block.
TILE = 8192
BLOCK = 256
BLOCK_BYTES = 1 << 18


def fingerprints_of(texts: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Unsigned 64-bit fingerprint of every text of a batch."""
    out = np.zeros(len(texts), np.uint64)
    for first, block in W.blocks(texts, BLOCK_BYTES):
        words = W.joined_by_space(W.cut(block, lower=True))
        counts = words.counts
        docs = np.flatnonzero(counts)
        n = np.maximum(counts[docs] - shingle + 1, 1)
        lead = W.spans(words.bounds[:-1][docs], n)
        last = np.minimum(lead + shingle, np.repeat(words.bounds[1:][docs], n)) - 1
        h = xxh64(words.data, words.start[lead], words.end[last], seed)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        if len(docs):
            ones = np.add.reduceat(bits, np.cumsum(n) - n, axis=0, dtype=np.int64)
            packed = np.packbits(2 * ones > n[:, None], axis=1, bitorder="little")
            out[first + docs] = packed.view("<u8").ravel()
    return out


def fingerprint(text: Column | str, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """The fingerprint of a text column as a signed long."""

    @F.arrow_udf(LongType())
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(fingerprints_of(texts, shingle, seed).view(np.int64))

    return of(text)


def _quarters(fp: np.ndarray) -> np.ndarray:
    return np.stack(
        [np.bitwise_count((fp >> np.uint64(16 * q)) & np.uint64(0xFFFF)) for q in range(QUARTERS)], 1
    ).astype(np.int64)


def _cell_column(fp: str) -> Column:
    cell = F.lit(0)
    for q in range(QUARTERS):
        quarter = F.shiftrightunsigned(fp, 16 * q).bitwiseAND(F.lit(0xFFFF))
        cell = cell * 17 + F.bit_count(quarter)
    return cell


def _steps(radius: int) -> np.ndarray:
    """Differences of quarter counts with a sum of at most `radius`, first nonzero one positive."""
    side = np.arange(-radius, radius + 1)
    grid = np.stack(np.meshgrid(*[side] * QUARTERS, indexing="ij"), -1).reshape(-1, QUARTERS)
    grid = grid[np.abs(grid).sum(1) <= radius]
    order = (grid * np.array([17**3, 17**2, 17, 1])).sum(1)
    return grid[order > 0]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node it is connected with."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            return root
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(root[root], root):
            root = root[root]


def _compare(home: np.ndarray, other: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect all of home and other which links connect."""
    nodes = np.concatenate([home, other])
    root = np.arange(len(nodes))
    for i in range(0, len(other), BLOCK):
        near = np.bitwise_count(other[i : i + BLOCK, None] ^ home[None, :]) <= radius
        o, h = np.nonzero(near)
        links = _forest(len(nodes), np.concatenate([np.arange(len(nodes)), h]), np.concatenate([root, o + i + len(home)]))
        root = links
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def links(nodes: DataFrame, fp: str, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """A spanning forest (a, b) of all pairs of distinct fingerprints within the radius.

    The counts of fingerprints by cell decide how many tiles a cell has; their
    number is bounded by the 17**4 cells, whatever the input.
    """
    counts = np.zeros(CELLS, np.int64)
    for row in nodes.groupBy(_cell_column(fp).alias("cell")).count().collect():
        counts[row["cell"]] = row["count"]
    steps = _steps(radius)
    grid = np.stack(np.unravel_index(np.arange(CELLS), [17] * QUARTERS), 1)
    visitors = np.zeros(CELLS, np.int64)
    for step in steps:
        to = grid + step
        ok = ((to >= 0) & (to <= 16)).all(1)
        np.add.at(visitors, np.ravel_multi_index(to[ok].T, [17] * QUARTERS), counts[ok])
    home_tiles = -(-counts // tile)
    visit_tiles = np.maximum(1, -(-(visitors + np.where(home_tiles > 1, counts, 0)) // (8 * tile)))

    def emit(batches):
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            quarters = _quarters(h)
            cell = np.ravel_multi_index(quarters.T, [17] * QUARTERS)
            pick = W.mix(h)
            spot = (pick % home_tiles[cell].astype(np.uint64)).astype(np.int64)
            parts = []

            def put(rows, cells, homes, visits, role):
                parts.append((cells, homes, visits, np.full(len(rows), role, np.int8), h[rows]))

            every = np.arange(len(h))
            rows = np.repeat(every, visit_tiles[cell])
            put(rows, cell[rows], spot[rows], W.spans(np.zeros(len(h), np.int64), visit_tiles[cell]), 0)
            # Other tiles of the same cell: met by those of lower number.
            lower = W.spans(np.zeros(len(h), np.int64), spot)
            rows = np.repeat(every, spot)
            visit = ((pick[rows] >> np.uint64(32)) % visit_tiles[cell[rows]].astype(np.uint64)).astype(np.int64)
            put(rows, cell[rows], lower, visit, 1)
            for step in steps:
                to = quarters + step
                rows = np.flatnonzero(((to >= 0) & (to <= 16)).all(1))
                cells = np.ravel_multi_index(to[rows].T, [17] * QUARTERS)
                times = home_tiles[cells]
                homes = W.spans(np.zeros(len(rows), np.int64), times)
                rows, cells = np.repeat(rows, times), np.repeat(cells, times)
                visit = ((pick[rows] >> np.uint64(32)) % visit_tiles[cells].astype(np.uint64)).astype(np.int64)
                put(rows, cells, homes, visit, 1)
            cells, homes, visits, role, out = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells.astype(np.int32)), pa.array(homes), pa.array(visits), pa.array(role), pa.array(out.view(np.int64))],
                names=["cell", "home", "visit", "role", "h"],
            )

    def compare(batches):
        key, home = None, []
        for batch in batches:
            cells, homes, visits, role, h = (batch.column(i).to_numpy() for i in range(5))
            new = np.ones(len(h), bool)
            new[1:] = (np.diff(cells) != 0) | (np.diff(homes) != 0) | (np.diff(visits) != 0)
            begins = np.flatnonzero(new)
            a, b = [], []
            for s, e in zip(begins, [*begins[1:], len(h)]):
                mine = (cells[s], homes[s], visits[s])
                if mine != key:
                    key, home = mine, np.zeros(0, np.uint64)
                m = s + int(np.count_nonzero(role[s:e] == 0))
                if m > s:
                    fresh = h[s:m].view(np.uint64)
                    both = np.concatenate([home, fresh])
                    if mine[2] == 0:
                        pairs = _compare(both, fresh, radius)
                        a.append(pairs[0]), b.append(pairs[1])
                    home = both
                if e > m and len(home):
                    pairs = _compare(home, h[m:e].view(np.uint64), radius)
                    a.append(pairs[0]), b.append(pairs[1])
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    tiles = nodes.select(fp).mapInArrow(emit, "cell int, home long, visit long, role tinyint, h long")
    keys = ["cell", "home", "visit"]
    dealt = tiles.repartition(partitions_for(nodes), *keys).sortWithinPartitions(*keys, "role")
    return dealt.mapInArrow(compare, "a long, b long").filter("a != b")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
) -> DataFrame:
    """One row per document: (id, `fp` signed long, `component_id` least id reachable)."""
    rows = freeze_python(docs.select(column(id_col).alias("id"), fingerprint(column(text_col), shingle, seed).alias("fp")), "simhash")
    nodes = freeze(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    roots = star_components(links(nodes, "fp", radius))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    named = freeze(rooted.select("fp", "root", "least"), "simhash-roots")
    # Stored, so that the join can split a component that holds many fingerprints.
    groups = freeze(named.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-groups")
    mapping = freeze(named.join(groups, "root").select("fp", "component_id"), "simhash-map")
    return rows.join(mapping, "fp").select("id", "fp", "component_id")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of `docs` that stay when each component keeps its least id.

    Rows that repeat the kept id stay too; rows without an id stay.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    gone = found.filter("id != component_id").select("id").distinct()
    drop = free_name("dropped_id", docs.columns)
    gone = gone.withColumnRenamed("id", drop)
    return docs.join(gone, column(id_col) == column(drop), "left_anti")
