"""Cross-tokenizer alignment by merge-path partitioning.

Each document is encoded twice: `space + text` by a byte-level BPE (A; its
`tokenizers` JSON vocabulary, ids computed by `bpe.ByteBPE`) and
`text` by a SentencePiece model that adds the space itself (B). A token's bytes
are A's byte-level string decoded, or B's piece in UTF-8 with U+2581 as a
space and `<0xHH>` as byte HH. Both token sequences cover the same bytes;
their end offsets are two sorted lists. An offset where an A token and a B
token both end cuts the sequences into groups; that (A, B) pair is a link.

Merge path. Merging the two end lists (A first on equal offsets) is cut into
pieces of at most `PIECE` merged elements: for each diagonal d = k * PIECE a
binary search finds the split (i, j), i + j = d, of A and B; a split that
would part an A end from the equal B end right after it moves by one. Pieces
are independent rows of at most PIECE merged elements, taken up by the encoding
task as they come and never stored; each finds
its common ends and writes its links, equal ones counted, and the text of its groups in three
fragments: the head (the group that started in an earlier piece), the body
(complete groups) and the tail (a group that continues). A document of one
piece is hashed where it is; fragments of others are stitched per document in
group order, A part before B part.

Counts: an (A id, B id) pair's count is how many links hold it, corpus-wide.
Per document: n_a, n_b, n_groups, n_links, n_best (links whose count is the
highest of their B id, ties included), count_sum (sum of the counts of its
links), and groups_sha256 of `a1,a2|b1;a3|b2,b3` (decimal ids in order).

Edge cases: a null or empty text, or one whose joined A or B bytes differ
from `space + text` (for example a text that B normalises), has no tokens:
counts 0 and groups_sha256 ''. Special-token strings inside texts are plain
text for both. Repeated rows and null ids are separate documents (a stored row
key tells them apart) and each adds its links to the counts. An empty table
gives an empty result; only the id and text columns are read, so other
columns never clash. Very long texts are encoded whole; their merge is split.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .bpe import ByteBPE
from .scratch import column, freeze, freeze_python

# Merged elements per piece; pair counts broadcast up to this many rows;
# bytes of text encoded at once (the encoders hold several times that).
PIECE = 1 << 11
BROADCAST_PAIRS = 1 << 20
ENCODE_BYTES = 1 << 20
# Tokens whose links and fragments are held as Python values at once.
SLICE_TOKENS = 1 << 16
PARTS = (
    "key long, doc_id long, n_a long, n_b long, piece int, pieces int, n_cuts long, links array<struct<a:int,b:int,n:int>>, "
    "frags array<struct<g:long,side:int,text:string>>"
)


_BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


class Encoders:
    """Both tokenizers and every id's bytes, loaded once per task."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = ByteBPE(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = self.a.token_bytes
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            m = _BYTE_PIECE.fullmatch(piece)
            self.b_bytes.append(bytes([int(m.group(1), 16)]) if m and self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)

    def encode(self, texts: list[str | None]):
        """Per text: (A ids, A ends, B ids, B ends), empty when not aligned."""
        live = [i for i, t in enumerate(texts) if t]
        a_enc = self.a.encode([" " + texts[i] for i in live], added_as_text=True)
        # Tasks fill the cores; threads of their own would only wait for each other.
        b_enc = self.b.encode([texts[i] for i in live], num_threads=1)
        empty = (np.zeros(0, np.int32), np.zeros(0, np.int64)) * 2
        out = [empty] * len(texts)
        for i, ea, eb in zip(live, a_enc, b_enc):
            target = (" " + texts[i]).encode()
            a_ids, b_ids = np.asarray(ea, np.int32), np.asarray(eb, np.int32)
            a_ends, b_ends = np.cumsum(self.a_len[a_ids]), np.cumsum(self.b_len[b_ids])
            if (
                len(a_ids) and len(b_ids) and a_ends[-1] == len(target) == b_ends[-1]
                and self.a.encoding.decode_bytes(ea) == target
                and b"".join(map(self.b_bytes.__getitem__, eb)) == target
            ):
                out[i] = (a_ids, a_ends, b_ids, b_ends)
        return out


def diagonal_split(a: np.ndarray, b: np.ndarray, d: int) -> tuple[int, int]:
    """(i, j), i + j = d: the first d elements of the merge of a and b, A first on ties.

    Binary search along the diagonal; a split between an A end and the equal
    B end that follows it moves so that both stay in one piece.
    """
    lo, hi = max(0, d - len(b)), min(d, len(a))
    while lo < hi:  # least i with b[d - i - 1] < a[i]
        i = (lo + hi) // 2
        if b[d - i - 1] < a[i]:
            hi = i
        else:
            lo = i + 1
    i, j = lo, d - lo
    if i > 0 and j < len(b) and a[i - 1] == b[j]:
        j += 1
    return i, j


def splits(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[list[int], list[int]]:
    """Split points (i_k, j_k) of equal-work pieces, from (0, 0) to (len a, len b)."""
    cut_i, cut_j = [0], [0]
    for d in range(piece, len(a) + len(b), piece):
        i, j = diagonal_split(a, b, d)
        if i + j > cut_i[-1] + cut_j[-1]:
            cut_i.append(i)
            cut_j.append(j)
    if len(a) + len(b):
        cut_i.append(len(a))
        cut_j.append(len(b))
    return cut_i, cut_j


def _slices(texts: list[str | None], limit: int = ENCODE_BYTES):
    """Row ranges of about `limit` characters of text each (one long text alone)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _encode_batch(enc: "Encoders", batch: pa.RecordBatch, piece: int):
    all_keys, all_ids, all_texts = (batch.column(k).to_pylist() for k in range(3))
    names = ("key", "doc_id", "n_a", "n_b", "total", "piece", "pieces", "a_start", "b_start", "a_ids", "b_ids")
    for lo, hi in _slices(all_texts):
        keys, ids, texts = all_keys[lo:hi], all_ids[lo:hi], all_texts[lo:hi]
        rows = {k: [] for k in names}
        for key, d, (a_ids, a_ends, b_ids, b_ends) in zip(keys, ids, enc.encode(texts)):
            ci, cj = splits(a_ends, b_ends, piece)
            bounds = list(zip(ci, ci[1:], cj, cj[1:])) or [(0, 0, 0, 0)]
            for k, (i0, i1, j0, j1) in enumerate(bounds):
                for name, value in zip(names, (
                    key, d, len(a_ids), len(b_ids), int(a_ends[-1]) if len(a_ends) else 0, k, len(bounds),
                    int(a_ends[i0 - 1]) if i0 else 0, int(b_ends[j0 - 1]) if j0 else 0,
                    a_ids[i0:i1], b_ids[j0:j1],
                )):
                    rows[name].append(value)
        yield pa.RecordBatch.from_pydict(rows, schema=_PIECES_ARROW)


_PIECES_ARROW = pa.schema([
    ("key", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("total", pa.int64()),
    ("piece", pa.int32()), ("pieces", pa.int32()), ("a_start", pa.int64()), ("b_start", pa.int64()),
    ("a_ids", pa.list_(pa.int32())), ("b_ids", pa.list_(pa.int32())),
])
_PARTS_ARROW = pa.schema([
    ("key", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("piece", pa.int32()), ("pieces", pa.int32()), ("n_cuts", pa.int64()),
    ("links", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())]))),
    ("frags", pa.list_(pa.struct([("g", pa.int64()), ("side", pa.int32()), ("text", pa.string())]))),
])


@lru_cache(maxsize=2)
def _decimals(size: int) -> np.ndarray:
    """The decimal texts of the ids below `size`, followed by `,`, then by `|`, then by `;`."""
    return np.array([f"{i}{sep}" for sep in ",|;" for i in range(size)], object)


def piece_groups(a_ids, a_ends, b_ids, b_ends, total):
    """Links and the fragments (local group, side, text) of one piece."""
    a, b, n_cuts, frags = _groups(a_ids, a_ends, b_ids, b_ends, total)
    return list(zip(a.tolist(), b.tolist())), n_cuts, frags


def _groups(a_ids, a_ends, b_ids, b_ends, total):
    # Both lists ascend, so the B end that may equal an A end is found by search.
    meets = np.searchsorted(b_ends, a_ends)
    a_cut, b_cut = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    a_cut[: np.searchsorted(meets, len(b_ends))] = True
    a_cut[a_cut] = b_ends[meets[a_cut]] == a_ends[a_cut]
    a_at = np.flatnonzero(a_cut)
    b_at = meets[a_at]
    b_cut[b_at] = True
    # All tokens by group, A before B. A group's tokens are one run of each list,
    # so a token moves on by the other list's tokens of the groups before.
    n = len(a_at)
    a_first, b_first = (np.concatenate([[0], at + 1, [size]]) for at, size in ((a_at, len(a_ids)), (b_at, len(b_ids))))
    size = 1 << max(16, int(max(a_ids.max(initial=0), b_ids.max(initial=0))).bit_length())
    code = np.empty(len(a_ids) + len(b_ids), np.int64)
    code[np.arange(len(a_ids)) + b_first[np.cumsum(a_cut) - a_cut]] = a_ids + size * a_cut.astype(np.int64)
    code[np.arange(len(b_ids)) + a_first[np.cumsum(b_cut) - b_cut + 1]] = b_ids + 2 * size * b_cut.astype(np.int64)
    elements = _decimals(size)[code].tolist()
    if len(b_ends) and b_ends[-1] == total:
        elements[-1] = str(int(b_ids[-1]))
    # Only the first and the last group can have parts in other pieces; those between are one text.
    start = a_first[:-1] + b_first[:-1]
    middle = start + np.diff(a_first)
    spans = [(0, 0, 0, middle[0]), (0, 1, middle[0], start[1] if n else len(elements))]
    if n:
        spans += [(1, 0, start[1], start[n]), (n, 0, start[n], middle[n]), (n, 1, middle[n], len(elements))]
    frags = [(g, side, "".join(elements[lo:hi])) for g, side, lo, hi in spans if hi > lo]
    return a_ids[a_cut], b_ids[b_cut], n, frags


def _token_slices(batch: pa.RecordBatch, limit: int | None = None):
    """Consecutive rows of about `limit` tokens of both lists."""
    limit = limit or SLICE_TOKENS
    sizes = pc.add(pc.list_value_length(batch.column("a_ids")), pc.list_value_length(batch.column("b_ids")))
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
    first = done = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(first, last - first)
        first, done = last, int(ends[last - 1])


def _lists(counts: list[int], kind: pa.ListType, columns: list) -> pa.Array:
    """Lists of structs from flat columns and the length of each list."""
    fields = [kind.value_type.field(i) for i in range(kind.value_type.num_fields)]
    flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], fields=fields)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), flat, type=kind)


_NONE = np.zeros(0, np.int64)


def _piece_batch(enc: "Encoders", batch: pa.RecordBatch) -> pa.RecordBatch:
    cols = {n: batch.column(n) for n in ("total", "a_start", "b_start", "a_ids", "b_ids")}
    cuts, n_links, n_frags = [], [], []
    links_a, links_b, links_n, groups, sides, texts = [], [], [], [], [], []
    for r in range(batch.num_rows):
        a_ids, b_ids = (np.asarray(cols[n][r].values.to_numpy(zero_copy_only=False)) for n in ("a_ids", "b_ids"))
        a_ends = cols["a_start"][r].as_py() + np.cumsum(enc.a_len[a_ids])
        b_ends = cols["b_start"][r].as_py() + np.cumsum(enc.b_len[b_ids])
        a, b, n_cuts, frags = _groups(a_ids, a_ends, b_ids, b_ends, cols["total"][r].as_py())
        pairs, n = np.unique(a.astype(np.int64) << 32 | b, return_counts=True)
        cuts.append(n_cuts)
        n_links.append(len(pairs))
        n_frags.append(len(frags))
        links_a.append(pairs >> 32)
        links_b.append(pairs & 0xFFFFFFFF)
        links_n.append(n)
        for g, side, text in frags:
            groups.append(g)
            sides.append(side)
            texts.append(text)
    return pa.RecordBatch.from_arrays(
        [
            *(batch.column(n) for n in ("key", "doc_id", "n_a", "n_b", "piece", "pieces")), pa.array(cuts, pa.int64()),
            _lists(n_links, _PARTS_ARROW.field("links").type, [np.concatenate([_NONE, *c]) for c in (links_a, links_b, links_n)]),
            _lists(n_frags, _PARTS_ARROW.field("frags").type, [groups, sides, texts]),
        ],
        schema=_PARTS_ARROW,
    )


def piece_results(docs: DataFrame, a_path: str, b_path: str, piece: int = PIECE) -> DataFrame:
    """Links and group fragments of every merge-path piece of a document (one
    without tokens keeps one row, piece 0, empty lists). Pieces go on in slices
    of few tokens; token ends are rebuilt from a piece's first byte and each
    id's byte length."""

    def run(batches):
        enc = Encoders(a_path, b_path)
        for batch in batches:
            for pieces in _encode_batch(enc, batch, piece):
                for part in _token_slices(pieces):
                    yield _piece_batch(enc, part)

    keyed = docs.select(F.monotonically_increasing_id().alias("key"), column("doc_id").cast("long"), column("text").cast("string"))
    return keyed.mapInArrow(run, PARTS)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          piece: int = PIECE) -> DataFrame:
    """Per document row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    src = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"))
    # Only what the pieces give is stored, once: it fixes the documents' keys.
    done = freeze_python(piece_results(src, a_path, b_path, piece), "align-pieces", compression="zstd")
    joined = lambda frags: F.sha2(F.array_join(F.transform(F.array_sort(frags), lambda s: s["text"]), ""), 256)
    # Groups before a piece: running sum over the pieces of a document (few rows each).
    before = Window.partitionBy("key").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    split = done.filter("pieces > 1").withColumn("g0", F.coalesce(F.sum("n_cuts").over(before), F.lit(0)))
    frags = split.select("key", "piece", "g0", F.explode("frags").alias("f")).select(
        "key", (F.col("g0") + F.col("f.g")).alias("g"), F.col("f.side").alias("side"), "piece", F.col("f.text").alias("text")
    )
    text = frags.groupBy("key").agg(joined(F.collect_list(F.struct("g", "side", "piece", "text"))).alias("stitched"))
    links = done.select("key", F.inline("links"))
    counts = freeze(links.groupBy("a", "b").agg(F.sum("n").alias("count")), "align-counts")
    best = counts.groupBy("b").agg(F.max("count").alias("top"))
    rated = counts.join(best, "b").select("a", "b", "count", (F.col("count") == F.col("top")).alias("is_best"))
    if rated.count() <= BROADCAST_PAIRS:
        rated = F.broadcast(rated)
    summed = links.join(rated, ["a", "b"]).groupBy("key").agg(
        F.sum("n").alias("n_links"),
        F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
    )
    own = F.when(F.expr("pieces = 1 AND n_a > 0"), joined(F.col("frags"))).alias("own")
    out = done.filter("piece = 0").select("key", "doc_id", "n_a", "n_b", own).join(summed, "key", "left").join(text, "key", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id", "n_a", "n_b",
        F.coalesce(F.col("n_links"), zero).cast("long").alias("n_groups"),
        F.coalesce(F.col("n_links"), zero).cast("long").alias("n_links"),
        F.coalesce(F.col("n_best"), zero).cast("long").alias("n_best"),
        F.coalesce(F.col("count_sum"), zero).cast("long").alias("count_sum"),
        F.coalesce("own", "stitched", F.lit("")).alias("groups_sha256"),
    )
