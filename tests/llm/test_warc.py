import gzip
import hashlib
import os
import random
import zlib

import pytest

from lorewell.llm import warc


@pytest.fixture(scope="module")
def pages():
    draw = random.Random(2)
    bodies = ["", "a" * 99, "b" * 100, "b" * 100, "é" * 60, "é" * 60, None, "x\x00\x1f\x8b\x08", "WARC/1.0\r\n\r\n" * 30]
    bodies += ["".join(chr(draw.randrange(32, 50000) if draw.random() < 0.5 else 65) for _ in range(4000)) for _ in range(20)]
    rows = [(i, f"http://x/{i}\r\nbad: 1" if i % 2 else None, body, i) for i, body in enumerate(bodies)]
    return [*rows, (None, None, "b" * 100, 1), (2, None, "b" * 100, 2)]


@pytest.mark.parametrize("range_bytes", [97, 1000, 1 << 20])
def test_round_trip(spark, pages, tmp_path, range_bytes):
    df = spark.createDataFrame(pages, "page_id long, url string, html string, record_id long").repartition(2)
    warc.write_archives(df, f"{tmp_path}/w")
    records = warc.resolve_revisits(warc.read_archives(spark, f"{tmp_path}/w", True, range_bytes)).collect()
    assert len(records) == len(pages)
    want = {str(p[0]) if p[0] is not None else None: (p[2] or "").encode() for p in pages}
    for r in records:
        body = want[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha256(body).hexdigest())
        assert r["payload_digest"] == r["declared_digest"]
        again = {"3": "2", "5": "4", None: "2"}.get(r["page_id"])
        assert (r["record_type"], r["refers_to"]) == (("revisit", again) if again else ("response", None))
        assert r["payload"] == (b"" if again else body)


def test_other_readers_understand_the_files(spark, pages, tmp_path):
    spark.createDataFrame(pages, "page_id long, url string, html string, x long").coalesce(1).write.parquet(f"{tmp_path}/p")
    warc.write_archives(spark.read.parquet(f"{tmp_path}/p"), f"{tmp_path}/w")
    found = 0
    for name in os.listdir(f"{tmp_path}/w"):
        if name.startswith("part-"):
            found += gzip.open(f"{tmp_path}/w/{name}").read().count(b"WARC/1.1\r\nWARC-Type: ")
    assert found == len(pages)


def _stored(data: bytes) -> bytes:
    pack = zlib.compressobj(0, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


@pytest.mark.parametrize("range_bytes", [50, 700, 5000, 1 << 20])
def test_members_inside_payloads_and_damage(spark, tmp_path, range_bytes):
    """Records stored raw in a payload, false magic, damaged members and long records."""
    draw = random.Random(1)
    noise = bytes(draw.randrange(256) for _ in range(3000))
    inner = warc._gzip(warc.record_bytes("77", "u", b"inner", "d", "r", None, warc.DATE))
    body = inner * 5 + noise + b"\x1f\x8b\x08" * 9
    members = [_stored(warc.record_bytes(str(i), None, body, "d", f"r{i}", None, warc.DATE)) for i in range(20)]
    members.append(_stored(warc.record_bytes("99", None, bytes(3 << 20), "d", "r99", None, warc.DATE)))
    broken = warc._gzip(warc.record_bytes("50", None, noise, "d", "r", None, warc.DATE))[:-30]
    os.makedirs(f"{tmp_path}/w")
    with open(f"{tmp_path}/w/a.warc.gz", "wb") as out:
        out.write(b"junk" + b"".join(members[:10]) + broken + warc.EMPTY_MEMBER + b"".join(members[10:]))
    got = warc.read_archives(spark, f"{tmp_path}/w", True, range_bytes).collect()
    assert sorted(int(r["page_id"]) for r in got) == [*range(20), 99]


def test_long_members_end_with_zero():
    data = os.urandom(17 << 20)
    member = warc._gzip(data)
    assert member[-1] != 0 and warc.EMPTY_MEMBER[-1] == 0
    assert gzip.decompress(member + warc.EMPTY_MEMBER) == data


def test_empty(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_path}/w")
    assert warc.read_archives(spark, f"{tmp_path}/w").count() == 0
