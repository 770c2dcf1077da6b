"""WARC archives: a distributed writer and a splittable reader.

Writing: every record is one gzip member. Records with equal payloads of at
least REVISIT_BYTES are stored once, at the least page id; the others are
revisit records that refer to it. Members are written by Spark's text sink,
whose commit protocol makes lost tasks harmless on any file system: a gzip
member under 16 MB ends with a zero byte, which is left to the sink as the line
separator; a longer one is followed by an empty member, which ends so too.

Reading: archives are cut into byte ranges, one row each. A task looks for gzip
magic in its range, accepts a candidate only if it inflates to a WARC header,
and owns the records that start inside its range, reading past the range's end
for the last one. From an accepted member on, it goes from end to start. A gzip
member stored inside a payload can be taken for a record when a range begins in
the middle of it; such records start before the end of an earlier record of the
file and are dropped.

Null payloads are empty. Null ids sort last: they revisit a known id, else they
are responses. Repeated rows of the least id are responses each. Members that do
not inflate are skipped.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import BinaryType

from .scratch import column, freeze, partitions_for

REVISIT_BYTES = 100
RANGE_BYTES = 8 << 20
CHUNK = 1 << 20
MAGIC = b"\x1f\x8b\x08"
START = b"WARC/"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
RECORD = (
    "path string, start long, end long, record_id string, record_type string, uri string, date string, "
    "page_id string, refers_to_record string, declared_digest string, payload_bytes long, payload_digest string, payload binary"
)


def _gzip(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


EMPTY_MEMBER = _gzip(b"")


def _clean(value: str) -> str:
    """A header value without control characters."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in value)


def record_bytes(page_id, uri, payload: bytes, digest: str, record_id: str, refers_to: str | None, date: str) -> bytes:
    """The uncompressed record of one page."""
    revisit = refers_to is not None
    head = HTTP_HEAD + b"Content-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:sha256:{record_id}>"),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if uri is not None:
        fields.append(("WARC-Target-URI", _clean(uri)))
    if page_id is not None:
        fields.append(("X-Page-ID", _clean(page_id)))
    if revisit:
        fields += [("WARC-Refers-To", f"<urn:sha256:{refers_to}>"), ("WARC-Profile", PROFILE)]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


@F.arrow_udf(BinaryType())
def _member(
    page_id: pa.Array, uri: pa.Array, payload: pa.Array, digest: pa.Array, record_id: pa.Array, refers_to: pa.Array, date: pa.Array
) -> pa.Array:
    """Gzip members without their last byte, which is zero."""
    out = []
    for row in zip(*(c.to_pylist() for c in (page_id, uri, payload, digest, record_id, refers_to, date))):
        member = _gzip(record_bytes(*row))
        if member[-1]:
            member += EMPTY_MEMBER
        out.append(member[:-1])
    return pa.array(out, pa.binary())


def _record_id(id_column) -> F.Column:
    return F.sha2(F.coalesce(F.concat(F.lit("page "), id_column), F.lit("no page")), 256)


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", date: str = DATE
) -> None:
    """Write one record per row of `pages` into archives in the folder `path`."""
    rows = pages.select(
        column(id_col).alias("id"), column(uri_col).cast("string").alias("uri"),
        F.encode(F.coalesce(column(payload_col), F.lit("")), "UTF-8").alias("payload"),
    ).withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload")})
    known = rows.filter(F.col("bytes") >= REVISIT_BYTES).groupBy("digest").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    known = freeze(known.filter("n > 1 and first is not null").select("digest", "first"), "payloads")
    placed = rows.join(known, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")) & (F.col("bytes") >= REVISIT_BYTES)
    refers_to = F.when(again, _record_id(F.col("first").cast("string")))
    text_id = F.col("id").cast("string")
    member = _member(text_id, "uri", "payload", "digest", _record_id(text_id), refers_to, F.lit(date))
    placed.select(member.cast("string").alias("member")).write.option("lineSep", "\x00").text(path)


def _open(uri: str):
    """A seekable stream of a file of the shared store."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return open(unquote(parsed.path), "rb")
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)


class _Window:
    """Bytes of a file from a moving position on, read chunk by chunk."""

    def __init__(self, stream, at: int):
        stream.seek(at)
        self.stream, self.at = stream, at
        self.data, self.used, self.ended = b"", 0, False

    def more(self) -> bool:
        chunk = b"" if self.ended else self.stream.read(CHUNK)
        self.ended = not chunk
        self.data, self.used = self.data[self.used :] + chunk, 0
        return not self.ended

    def drop(self, n: int) -> None:
        self.used, self.at = self.used + n, self.at + n

    def find_magic(self, limit: int) -> bool:
        """Move to the next magic that starts before `limit`."""
        while self.at < limit:
            spot = self.data.find(MAGIC, self.used)
            if spot >= 0:
                self.drop(spot - self.used)
                return self.at < limit
            self.drop(max(0, len(self.data) - self.used - len(MAGIC) + 1))
            if not self.more():
                return False
        return False


def _inflate(window: _Window) -> tuple[bytes, int] | None:
    """Content and packed length of the member at the window, None if there is none.

    The head is tried first: what does not begin like a record is not inflated.
    """
    unpack, length, parts, head = zlib.decompressobj(31), 0, [], b""
    while not unpack.eof:
        if window.used + length == len(window.data) and not window.more():
            return None
        spot = window.used + length
        piece = window.data[spot : spot + (CHUNK if parts else 4096)]
        try:
            out = unpack.decompress(piece)
        except zlib.error:
            return None
        length += len(piece) - len(unpack.unused_data)
        parts.append(out)
        head = (head + out[: len(START)])[: len(START)]
        if not START.startswith(head):
            return None
    return b"".join(parts), length


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields in lower case and the payload behind the HTTP head."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[: int(fields.get("content-length", len(rest)))]
    if fields.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    return fields, block


def _records_of_range(uri: str, start: int, end: int) -> Iterator[tuple]:
    with _open(uri) as stream:
        window = _Window(stream, start)
        while window.find_magic(end):
            found = _inflate(window)
            if found is None:
                window.drop(1)
                continue
            data, length = found
            at = window.at
            window.drop(length)
            if not data:
                continue
            fields, payload = parse_record(data)
            yield at, at + length, fields, payload


def _bare(value: str | None) -> str | None:
    return value[1:-1].removeprefix("urn:sha256:") if value and value[0] == "<" else value


def _reader(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start, end in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows, held = [], 0
                for at, to, fields, payload in _records_of_range(uri, start, end):
                    digest = hashlib.sha256(payload).hexdigest()
                    rows.append((
                        uri, at, to, _bare(fields.get("warc-record-id")), fields.get("warc-type"), fields.get("warc-target-uri"),
                        fields.get("warc-date"), fields.get("x-page-id"), _bare(fields.get("warc-refers-to")),
                        fields.get("warc-payload-digest", "").removeprefix("sha256:") or None, len(payload), digest,
                        payload if with_payload else None,
                    ))
                    held += len(payload) * with_payload
                    if len(rows) >= 10_000 or held > 16 << 20:
                        yield _rows(rows)
                        rows, held = [], 0
                yield _rows(rows)

    return read


SCHEMA = pa.schema([
    (name, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[kind])
    for name, kind in (field.split() for field in RECORD.split(", "))
])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA)], schema=SCHEMA)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the archives in `path`, one row each (see RECORD)."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.select("path", starts.alias("start")).select("path", "start", (F.col("start") + range_bytes).alias("end"))
    dealt = ranges.repartition(partitions_for(files), "path", "start")
    records = dealt.mapInArrow(_reader(with_payload), RECORD)
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reach = records.withColumn("reach", F.max("end").over(before))
    return reach.filter(F.col("reach").isNull() | (F.col("start") >= F.col("reach"))).drop("reach")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """`records` with `refers_to` (page id), and bytes and digest of the full payload
    for revisits too, taken from the record they refer to."""
    stored = freeze(records, "records")
    direct = stored.filter("record_type != 'revisit'")
    revisits = stored.filter("record_type = 'revisit'")
    target = direct.select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("full_bytes"), F.col("payload_digest").alias("full_digest"),
    )
    found = revisits.join(target.dropDuplicates(["refers_to_record"]), "refers_to_record", "left")
    full = found.withColumns({"payload_bytes": F.col("full_bytes"), "payload_digest": F.col("full_digest")})
    return direct.withColumn("refers_to", F.lit(None).cast("string")).unionByName(full.drop("full_bytes", "full_digest"))
