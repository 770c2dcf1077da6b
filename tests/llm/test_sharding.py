from collections import Counter

import pytest

from lorewell.llm import sharding


@pytest.mark.parametrize("bucket_bytes", [sharding.BUCKET_BYTES, 2000])
def test_rows_are_dealt_evenly(spark, odd_docs, bucket_bytes):
    got = sharding.shard(odd_docs, 7, bucket_bytes=bucket_bytes)
    assert got.columns == [*odd_docs.columns, "shard_", "slot_"]
    rows = got.collect()
    assert sorted(map(str, (r[:-2] for r in rows))) == sorted(map(str, (tuple(r) for r in odd_docs.collect())))
    counts = Counter(r["shard_"] for r in rows)
    assert set(counts) <= set(range(7)) and max(counts.values()) - min(counts[s] for s in range(7)) <= 1
    for shard in counts:
        assert sorted(r["slot_"] for r in rows if r["shard_"] == shard) == list(range(counts[shard]))


def test_order_is_random_and_seeded(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "repeat('x', 20) as text").repartition(4).cache()
    docs.count()

    def order(seed):
        rows = sharding.shard(docs, 4, seed=seed, bucket_bytes=20_000).collect()
        return [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]

    first = order(1)
    assert sorted(first) == list(range(4000)) and first == order(1) and first != order(2)
    # Neighbours of the input are spread over all shards, and buckets are permuted inside.
    assert Counter(first.index(i) // 1000 for i in range(400)).most_common()[-1][1] > 60
    rising = sum(a < b for a, b in zip(first, first[1:]))
    assert 1800 < rising < 2200


def test_write_and_empty(spark, odd_docs, tmp_path):
    sharded = sharding.shard(odd_docs, 5)
    sharding.write_shards(sharded.withColumnsRenamed({"shard_": "part", "slot_": "place"}), f"{tmp_path}/s", "part", "place")
    assert spark.read.parquet(f"{tmp_path}/s").count() == odd_docs.count()
    assert sharding.shard(odd_docs.limit(0), 5).count() == 0


def test_no_python_in_the_plan(spark, odd_docs):
    plan = sharding.shard(odd_docs, 5)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
