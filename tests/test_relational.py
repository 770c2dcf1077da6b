import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorewell.operators import aggregates, joins, ranking, reshape
from lorewell.operators.versions import distinct_versions, select_versions


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    # One key holds more than a third of the left side.
    left = spark.range(9000).select(
        F.when(F.col("id") % 5 < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("key"), "id"
    )
    right = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("k1", "c"), ("k3", "d"), ("zz", "e")], "key string, v string")
    return left, right


def test_hot_keys(skewed):
    assert joins.hot_keys(skewed[0], "key", 0.05) == ["hot"]
    assert joins.hot_keys(skewed[0].limit(0), "key") == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_join(skewed, how):
    left, right = skewed
    salted = joins.salted_join(left, right, "key", how, salts=7, min_share=0.05)
    assert rows(salted) == rows(left.join(right, "key", how))


def test_salted_join_spreads_the_hot_key(spark, skewed):
    left, right = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = joins.salted_join(left, right.filter("v <> 'b'"), "key", salts=16, min_share=0.05)
        sizes = joined.filter("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 3 and max(r["count"] for r in sizes) < 3600 / 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_every_key_above_the_share_is_found(spark):
    keys = spark.range(90_000).selectExpr("concat('k', id % 90) as key")
    others = spark.range(1000).selectExpr("concat('rare', id) as key")
    assert len(joins.hot_keys(keys.union(others), "key", 0.01)) == 90


def test_equal_rows_of_a_hot_key_use_all_salts(spark):
    left = spark.range(20_000).selectExpr("'hot' as key", "id % 4 as step").union(spark.createDataFrame([("b", 1), (None, 2)], "key string, step long"))
    dealt = joins._deal(left, "key", ["hot"], 32, "n").filter("key = 'hot'").groupBy("_salt").agg(F.sum("n").alias("n")).collect()
    assert len(dealt) == 32 and max(r["n"] for r in dealt) < 700 and sum(r["n"] for r in dealt) == 20_000
    right = spark.createDataFrame([("hot", "x"), ("hot", "y"), ("b", "z")], "key string, v string")
    for how in ("inner", "left", "left_semi"):
        joined = joins.salted_join(left, right, "key", how, salts=32, hot=["hot"])
        assert rows(joined.groupBy(*joined.columns).count()) == rows(left.join(right, "key", how).groupBy(*joined.columns).count())


def test_salted_join_rejects_other_kinds(skewed):
    with pytest.raises(ValueError):
        joins.salted_join(*skewed, "key", "full_outer")


def test_null_keys_do_not_match(spark):
    left = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "key string, x int")
    right = spark.createDataFrame([(None, 1), ("a", 2)], "key string, y int")
    assert rows(joins.salted_join(left, right, "key")) == [("a", 3, 2)]
    assert len(rows(joins.salted_join(left, right, "key", "left"))) == 3


def test_top_joined_equals_full_join(spark):
    rnd = random.Random(5)
    left = spark.createDataFrame(
        [(f"r{rnd.randrange(12)}", i, rnd.choice([None, 0.1, 0.2, 0.3])) for i in range(300)],
        "key string, step int, score double",
    )
    right = spark.createDataFrame(
        [(f"r{rnd.randrange(14)}", f"v{rnd.randrange(3)}", f"o{i}") for i in range(60)], "key string, grp string, out string"
    )
    order = [F.col("score").asc_nulls_first(), F.col("step").asc()]
    full = ranking.top_per_group(
        left.join(right, "key"), ["grp"], [*order, F.col("key").asc(), F.col("out").asc()], 5
    )
    for bound in (None, 3):
        fast = ranking.top_joined(left, right, "key", "grp", order, [F.col("out").asc()], 5, bound)
        assert rows(fast.select(*sorted(fast.columns))) == rows(full.select(*sorted(full.columns)))


def test_group_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = ranking.top_per_group(df, ["g"], [F.col("id").asc()], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def logs(spark):
    requests = spark.createDataFrame(
        [("a", "m/1"), ("a", "m/2"), ("b", "m/1"), ("b", "m/1"), ("c", "m/2")], "i string, v string"
    ).select(F.struct(F.col("i").alias("request_id")).alias("request"), F.struct(F.col("v").alias("app_version_id")).alias("trace"))
    assessments = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("b", 4.0), ("c", None), ("x", 9.0)], "request_id string, score double"
    )
    return requests, assessments


def test_means_over_join_keep_fan_out(spark):
    requests, assessments = logs(spark)
    got = {r.rag_version: (r.score, r.n) for r in aggregates.means_over_join(assessments, requests, ["score"], "n").collect()}
    # Version 1: a twice, b's row once per duplicate request row.
    assert got == {"1": (3.0, 4), "2": (1.0, 3)}


@pytest.mark.parametrize("n_ranges", [1, 4, 16])
def test_exact_quantiles(spark, n_ranges):
    rnd = np.random.default_rng(3)
    data = {"a": rnd.integers(0, 50, 1000).astype(float), "b": rnd.normal(size=333), "c": np.array([2.5])}
    flat = [(g, float(v)) for g, vs in data.items() for v in vs] + [("d", None)]
    counted = spark.createDataFrame(flat, "g string, v double").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    probabilities, names = (0.0, 0.1, 0.5, 0.99, 1.0), ("p0", "p10", "p50", "p99", "p100")
    got = {r.g: r for r in aggregates.exact_quantiles(counted, "g", "v", probabilities, names, ranges=n_ranges).collect()}
    assert set(got) == {"a", "b", "c"}
    for g, vs in data.items():
        assert got[g].n_scores == len(vs)
        assert np.allclose([got[g][n] for n in names], np.quantile(vs, probabilities))


def test_approximate_quantiles(spark):
    df = spark.range(1001).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    row = aggregates.approximate_quantiles(df, "g", "v", (0.0, 0.5, 1.0), ("lo", "mid", "hi")).first()
    assert (row.lo, row.hi) == (0.0, 1000.0) and abs(row.mid - 500) < 3


def test_wide_to_long_equals_union(spark):
    from lorewell.schemas import RETRIEVAL_RATINGS, RANK_METRICS, rank_metric_name

    def rating(x):
        return (None, x)

    full = tuple(rating(float(i)) for i in range(9))
    partly = tuple(rating(None if i // 3 == 1 else 0.5) for i in range(9))
    df = spark.createDataFrame([("a", full), ("b", partly), ("c", None)], "id string, ratings " + RETRIEVAL_RATINGS.simpleString())
    long = reshape.rank_scores_long(df, ["id"])
    branches = None
    for k in (1, 3, 5):
        part = df.select(
            "id", F.lit(k).alias("k"),
            *[F.col(f"ratings.{rank_metric_name(m, k)}.double_value").alias(f"retrieval_{m}_at_k_score") for m in RANK_METRICS],
        )
        branches = part if branches is None else branches.unionByName(part)
    branches = branches.filter("coalesce(retrieval_recall_at_k_score, retrieval_precision_at_k_score, retrieval_ndcg_at_k_score) is not null")
    assert rows(long) == rows(branches)
    assert len(rows(long)) == 5


def test_versions(spark):
    requests, _ = logs(spark)
    assert [r[0] for r in distinct_versions(requests).collect()] == ["m/1", "m/2"]
    column = "trace.app_version_id"
    assert select_versions(requests, ["m/2", "*"], column).count() == 5
    assert select_versions(requests, None, column).count() == 5
    assert select_versions(requests, ["m/2"], column).count() == 2


def test_pivot_picks_the_first_in_order(spark):
    df = spark.createDataFrame([("a", "x", 2), ("a", "x", 1), ("a", "y", 5), ("b", "y", 7)], "id string, v string, n int")
    wide = reshape.pivot_versions(df, ["id"], "v", ["x", "y"], "n", F.col("n"))
    assert rows(wide) == [("a", 1, 5), ("b", None, 7)]


def test_lookup_join_in_both_forms(spark, skewed, monkeypatch):
    large, small = skewed
    want = rows(large.join(small, "key"))
    assert rows(joins.lookup_join(small, large, "key").select("key", "id", "v")) == want
    schema = joins.lookup_join(small, large, "key").schema
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    assert joins.lookup_join(small, large, "key").schema == schema
    assert rows(joins.lookup_join(small, large, "key").select("key", "id", "v")) == want


def test_measured_bytes(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "s string, n int")
    assert joins.measured_bytes(df) == 2 * (16 + 8) + 3
    assert joins.measured_bytes(df.limit(0)) == 0


def test_salted_join_with_a_hot_right_key(skewed):
    left, right = skewed
    want = rows(right.join(left, "key"))
    got = joins.salted_join(right, left, "key", salts=5, hot=[], right_hot=["hot"])
    assert rows(got) == want
    with pytest.raises(ValueError):
        joins.salted_join(right, left, "key", "left", hot=[], right_hot=["hot"])
