"""Token ids in packed binary rows: best-fit-decreasing with a segment tree.

Documents are tokenized, split losslessly where they exceed the row length, and
packed into rows of fixed length: pieces go, longest first, into the fullest row
that still has room. Rows of a block are kept in a segment tree over their free
capacity, so a search takes log(row length) steps. Blocks are random sets of
about BLOCK_TOKENS tokens, gathered by a seeded hash of the row's content, so
memory is bounded and no group of copies meets in one block.

Output rows hold the id matrix row as little-endian bytes, the cumulative
segment lengths and the position ids that restart with each segment, plus the
segments' origin, from which every document can be put together again. Padding
is the pad id; it belongs to no segment and its positions are 0.

Null and blank texts have no tokens and so no segment (they are counted by
`tokenize`). Equal rows are separate documents. A null id stays null.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .scratch import column, partitions_for

# Fixed value: the splitting pattern published with the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ROW_TOKENS = 2048
BLOCK_TOKENS = 4_000_000
# Bytes of text a token stands for, to size blocks before tokenizing; low, so that
# blocks come out smaller rather than larger.
BYTES_A_TOKEN = 2
SEED = 42


class BestFit:
    """Open rows by free capacity. Node i of the tree says whether any row has a
    free capacity in its range; leaves stand for the capacities 0 to row length."""

    def __init__(self, row_tokens: int):
        self.size = 1
        while self.size <= row_tokens:
            self.size *= 2
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(row_tokens + 1)]

    def _add(self, capacity: int, change: int) -> None:
        node = capacity + self.size
        while node:
            self.count[node] += change
            node //= 2

    def push(self, row: int, capacity: int) -> None:
        self.rows[capacity].append(row)
        self._add(capacity, 1)

    def pop(self, need: int) -> tuple[int, int] | None:
        """The row with the least free capacity of at least `need`."""
        node = need + self.size
        if not self.count[node]:
            # Climb until a right neighbour's range has a row, then descend to its least.
            while node > 1 and (node % 2 or not self.count[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.size
        self._add(capacity, -1)
        return self.rows[capacity].pop(), capacity


def best_fit_decreasing(lengths: np.ndarray, row_tokens: int) -> list[list[int]]:
    """Rows of piece numbers; each piece is at most `row_tokens` long."""
    open_rows, rows = BestFit(row_tokens), []
    for piece in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[piece])
        found = open_rows.pop(length)
        if found is None:
            row, capacity = len(rows), row_tokens
            rows.append([])
        else:
            row, capacity = found
        rows[row].append(piece)
        if capacity > length:
            open_rows.push(row, capacity - length)
    return rows


def _encoder(data: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def read_vocabulary(path: str) -> bytes:
    """The file of a vocabulary; some megabytes, sent to every task."""
    with open(path, "rb") as stream:
        return stream.read()


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    row_tokens: int = ROW_TOKENS, pad_id: int = 50256, eos_id: int | None = 50256,
    block_tokens: int = BLOCK_TOKENS, seed: int = SEED, pattern: str = PATTERN,
) -> DataFrame:
    """Packed rows: (block, row, n_tokens, ids, cu_seqlens, positions, segments).

    `ids` and `positions` are little-endian int32 of row_tokens entries;
    `cu_seqlens` starts with 0; `segments` has (id, key, first, length, n_doc_tokens)
    in the order of `cu_seqlens`. `key` is a hash of id and text; with `eos_id` each
    document ends with that token, so the tokens of a document are those of its
    text plus one.
    """
    spark: SparkSession = docs.sparkSession
    sent = spark.sparkContext.broadcast(read_vocabulary(vocabulary))
    text = F.coalesce(column(text_col), F.lit(""))
    rows = docs.select(
        column(id_col).cast("string").alias("id"), F.xxhash64(column(id_col), column(text_col)).alias("key"), text.alias("text")
    ).filter("text != ''")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // (block_tokens * BYTES_A_TOKEN)))
    # Rows equal in id and text would share a block; their place in the input parts them.
    block = F.pmod(F.xxhash64(F.lit(seed), "key", F.monotonically_increasing_id()), F.lit(n_blocks)).cast("int")
    dealt = rows.withColumn("block", block).repartition(partitions_for(docs), "block").sortWithinPartitions("block", "key", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value, pattern)
        held, number = [], None
        for batch in batches:
            ids, keys, texts, blocks = (batch.column(i).to_pylist() for i in range(4))
            for doc_id, key, value, mine in zip(ids, keys, texts, blocks):
                if mine != number:
                    yield from _packed(held, number, row_tokens, pad_id)
                    held, number = [], mine
                tokens = encoder.encode_ordinary(value)
                if eos_id is not None:
                    tokens.append(eos_id)
                held.append((doc_id, key, np.array(tokens, np.int32)))
        yield from _packed(held, number, row_tokens, pad_id)

    return dealt.mapInArrow(
        run,
        "block int, row int, n_tokens int, ids binary, cu_seqlens array<int>, positions binary, "
        "segments array<struct<id: string, key: long, first: long, length: int, n_doc_tokens: long>>",
    )


def _packed(docs: list[tuple], block: int | None, row_tokens: int, pad_id: int) -> Iterator[pa.RecordBatch]:
    if not docs:
        return
    pieces = [(d, at) for d, (_, _, tokens) in enumerate(docs) for at in range(0, len(tokens), row_tokens)]
    lengths = np.array([min(row_tokens, len(docs[d][2]) - at) for d, at in pieces], np.int64)
    kind = pa.list_(pa.struct([("id", pa.string()), ("key", pa.int64()), ("first", pa.int64()), ("length", pa.int32()), ("n_doc_tokens", pa.int64())]))
    packed = best_fit_decreasing(lengths, row_tokens)
    for lo in range(0, len(packed), 512):
        columns: list[list] = [[] for _ in range(7)]
        for row, members in enumerate(packed[lo : lo + 512], lo):
            ids, positions = np.full(row_tokens, pad_id, "<i4"), np.zeros(row_tokens, "<i4")
            ends, segments = [0], []
            for piece in members:
                (d, first), n = pieces[piece], int(lengths[piece])
                doc_id, key, tokens = docs[d]
                ids[ends[-1] : ends[-1] + n] = tokens[first : first + n]
                positions[ends[-1] : ends[-1] + n] = np.arange(n)
                ends.append(ends[-1] + n)
                segments.append({"id": doc_id, "key": key, "first": first, "length": n, "n_doc_tokens": len(tokens)})
            for c, v in zip(columns, (block, row, ends[-1], ids.tobytes(), ends, positions.tobytes(), segments)):
                c.append(v)
        types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(), kind)
        names = ["block", "row", "n_tokens", "ids", "cu_seqlens", "positions", "segments"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the packed rows as a table with one folder per block range, rows in order."""
    packed.sortWithinPartitions("block", "row").write.parquet(path)
