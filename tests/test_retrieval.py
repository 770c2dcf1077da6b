import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.queries import knn_exact_top5, knn_lsh
from lorewell.operators import knn, mmr
from lorewell.operators.embed import embed_text
from lorewell.plans import answering


def frame(spark, vectors, name):
    rows = [(f"c{i:03d}", [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{name} string, v array<float>").repartition(3)


def brute(queries, corpus, k, skip_same=False):
    out = set()
    scores = np.round(np.float64(np.float32(queries)) @ np.float64(np.float32(corpus)).T, 9)
    for q, line in enumerate(scores):
        ids = [i for i in np.lexsort((np.arange(len(line)), -line)) if not (skip_same and i == q)]
        out |= {(f"c{q:03d}", f"c{i:03d}", r) for r, i in enumerate(ids[:k], 1)}
    return out


def ranked(df):
    return {(r.query_id, r.chunk_id, r["rank"]) for r in df.collect()}


@pytest.fixture(scope="module")
def data():
    rnd = np.random.default_rng(11)
    corpus = rnd.normal(size=(203, 16))
    corpus[50:90] = corpus[50]  # many ties
    return rnd.normal(size=(31, 16)), corpus


@pytest.mark.parametrize("mode", [{}, {"broadcast_bytes": 0, "group_bytes": 4096}])
def test_exact_neighbours(spark, data, mode):
    queries, corpus = data
    q, c = frame(spark, queries, "q"), frame(spark, corpus, "chunk_id")
    got = knn.nearest(q, c, 5, query_id="q", query_vector="v", vector="v", **mode)
    assert ranked(got) == brute(queries, corpus, 5)


@pytest.mark.parametrize("mode", [{}, {"broadcast_bytes": 0, "group_bytes": 4096}])
def test_self_join_leaves_out_the_query(spark, data, mode):
    _, corpus = data
    c = frame(spark, corpus, "chunk_id")
    got = knn.nearest(c, c, 3, query_id="chunk_id", query_vector="v", vector="v", exclude_same_id=True, **mode)
    assert ranked(got) == brute(corpus, corpus, 3, skip_same=True)


def test_fewer_chunks_than_k_and_no_queries(spark, data):
    queries, corpus = data
    q = frame(spark, queries[:2], "q")
    c = frame(spark, corpus[:3], "chunk_id")
    args = dict(query_id="q", query_vector="v", vector="v")
    assert knn.nearest(q, c, 5, **args).count() == 6
    assert knn.nearest(q.limit(0), c, 5, **args).count() == 0
    assert knn.nearest(q, c.limit(0), 5, **args).count() == 0


@pytest.mark.parametrize("mode", [{}, {"broadcast_bytes": 0, "group_bytes": 4096}])
def test_lsh_scores_are_exact_and_recall_is_high(spark, mode):
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(8, 16)) * 4
    corpus = np.concatenate([c + rnd.normal(size=(40, 16)) for c in centres])
    queries = centres + rnd.normal(size=(8, 16)) * 0.5
    q, c = frame(spark, queries, "q"), frame(spark, corpus, "chunk_id")
    args = dict(query_id="q", query_vector="v", vector="v", **mode)
    exact = {(r.query_id, r.chunk_id): r.score for r in knn.nearest(q, c, len(corpus), **args).collect()}
    found = knn.nearest(q, c, 5, lsh=(8, 4), **args).collect()
    assert all(abs(exact[(r.query_id, r.chunk_id)] - r.score) < 1e-9 for r in found)
    assert len({(r.query_id, r.chunk_id) for r in found}) == len(found)
    best = {(a, b) for a, b, _ in brute(queries, corpus, 5)}
    assert len(best & {(r.query_id, r.chunk_id) for r in found}) / len(best) > 0.8


def test_registered_lsh_finds_the_exact_neighbours(spark):
    pairs = lambda query: {(r.query_id, r.chunk_id) for r in query(spark, "/root/testdata/sf0.01").collect()}
    exact = pairs(knn_exact_top5)
    assert len(exact) == 5 * 500 and len(exact & pairs(knn_lsh)) / len(exact) >= 0.95


def test_no_pair_join_in_the_plan(spark, data):
    queries, corpus = data
    q, c = frame(spark, queries, "q"), frame(spark, corpus, "chunk_id")
    plan = knn.nearest(q, c, 5, query_id="q", query_vector="v", vector="v")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan


def candidates(spark):
    rows = [
        (1, "a", 0.9, 1, [1.0, 0.0]), (1, "b", 0.89, 2, [1.0, 0.01]), (1, "c", 0.5, 3, [0.0, 1.0]),
        (2, "a", 0.3, 1, [1.0, 0.0]),
    ]
    return spark.createDataFrame(rows, "query_id int, chunk_id string, score double, rank int, embedding array<float>")


def test_mmr(spark):
    pick = lambda df: sorted((r.query_id, r["rank"], r.chunk_id) for r in df.collect())
    assert pick(mmr.mmr_rerank(candidates(spark), 2, 1.0)) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "a")]
    assert pick(mmr.mmr_rerank(candidates(spark), 2, 0.5)) == [(1, 1, "a"), (1, 2, "c"), (2, 1, "a")]


def test_hashed_embedding(spark):
    df = spark.createDataFrame([(1, "a b b"), (2, "B A b"), (3, ""), (4, None), (5, "c")], "id int, text string")
    rows = {r.id: np.array(r.embedding) for r in embed_text(df, dim=32).collect()}
    assert all(len(v) == 32 for v in rows.values())
    assert np.allclose(rows[1], rows[2]) and np.isclose(np.linalg.norm(rows[1]), 1)
    assert not rows[3].any() and not rows[4].any()
    assert not np.allclose(rows[1], rows[5])


def test_embedder_gets_instruction_and_batches(spark):
    def make():
        def embed(texts):
            assert len(texts) <= 3
            return [[float(len(t)), float(t.startswith("find: "))] for t in texts]

        return embed

    df = spark.range(10).select(F.col("id").cast("string").alias("text")).coalesce(1)
    out = embed_text(df, instruction="find:", make_embedder=make, batch_size=3).collect()
    assert {tuple(r.embedding) for r in out} == {(7.0, 1.0)}


def _clustered(n_clusters=40, per=50, dim=16, seed=11):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n_clusters, dim)) * 4
    rows = []
    for c in range(n_clusters):
        for v in centres[c] + rng.standard_normal((per, dim)) * 0.2:
            rows.append((len(rows), [float(x) for x in v]))
    return rows


def test_cell_index_equals_exact_search_and_skips_cells(spark):
    from lorewell.operators import ivf

    rows = _clustered()
    c = spark.createDataFrame(rows, "chunk_id long, embedding array<double>")
    q = c.select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    index = ivf.build(c, cells=40)
    got = sorted((r.query_id, r.chunk_id, round(r.score, 6), r.rank) for r in ivf.nearest(index, q, 5, exclude_same_id=True).collect())
    want = sorted((r.query_id, r.chunk_id, round(r.score, 6), r.rank) for r in knn.nearest(q, c, 5, exclude_same_id=True).collect())
    assert got == want
    share = ivf.scored_pairs(index, q, 5) / len(rows) ** 2
    assert share < 0.15


def test_cell_index_on_odd_input(spark):
    from lorewell.operators import ivf

    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 1.0]), (5, [0.5, 0.5])]
    c = spark.createDataFrame(rows, "chunk_id long, embedding array<double>")
    q = c.select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    index = ivf.build(c, cells=2)
    got = sorted(tuple(r) for r in ivf.nearest(index, q, 2, exclude_same_id=True).collect())
    want = sorted(tuple(r) for r in knn.nearest(q, c, 2, exclude_same_id=True).collect())
    assert got == want
    empty = ivf.build(c.limit(0))
    assert ivf.nearest(empty, q, 2).count() == 0


def test_dense_buckets_are_scored_as_whole_blocks(spark, monkeypatch):
    import pyarrow as pa

    rnd = np.random.default_rng(3)
    queries, corpus = rnd.normal(size=(3000, 16)), rnd.normal(size=(400, 16))
    planes, calls = knn.Planes(16, 40, 5, 17), []
    codes = planes.buckets(queries)
    ids = pa.array(range(400))
    best = knn.Best(5, ids.type, None, len(queries))
    offer = best.offer
    monkeypatch.setattr(best, "offer", lambda *a: (calls.append(1), offer(*a)))
    knn.score_batch(best, knn.Block(pa.array(range(3000)), queries, codes), corpus, ids, planes)
    assert len(calls) <= 4  # 40 tables of 32 buckets before
    share = (codes[:, :, None] == planes.buckets(corpus)[:, None, :]).any(0)
    scores = np.where(share, np.round(queries @ corpus.T, 9), -np.inf)
    want = {(q, c) for q, line in enumerate(scores) for c in np.argsort(-line, kind="stable")[:5] if line[c] > -np.inf}
    found = best.prune()
    assert set(zip(found["q"].to_pylist(), found["id"].to_pylist())) == want


def test_sparse_buckets_give_the_same_neighbours(monkeypatch):
    import pyarrow as pa

    rnd = np.random.default_rng(5)
    queries, corpus = rnd.normal(size=(300, 16)), rnd.normal(size=(5000, 16))
    planes, ids = knn.Planes(16, 6, 6, 17), pa.array(range(5000))
    block = knn.Block(pa.array(range(300)), queries, planes.buckets(queries))

    def run():
        best = knn.Best(5, ids.type, None, len(queries))
        for at in range(0, 5000, 1000):
            knn.score_batch(best, block, corpus[at : at + 1000], ids[at : at + 1000], planes)
        return best.prune().to_pydict()

    sparse = run()
    monkeypatch.setattr(knn, "_matches", lambda *_: 1 << 60)
    assert run() == sparse


def test_tied_scores_do_not_pile_up():
    import pyarrow as pa

    ids = pa.array(range(9000, 0, -1))
    best = knn.Best(5, ids.type, None, 100)
    taken = []
    take = best.take
    best.take = lambda q, at, score, ids: (taken.append(len(q)), take(q, at, score, ids))
    knn.score_batch(best, knn.Block(pa.array(range(100)), np.zeros((100, 8))), np.ones((9000, 8)), ids)
    assert max(taken) <= 2 * 5 * 100  # all 900,000 pairs before
    assert best.prune()["id"].to_pylist() == [1, 2, 3, 4, 5] * 100


def test_small_blocks_share_a_reading_of_the_corpus(spark, data):
    queries, corpus = data
    q, c = frame(spark, queries, "q"), frame(spark, corpus, "chunk_id")
    args = dict(query_id="q", query_vector="v", vector="v", broadcast_bytes=0, group_bytes=256)
    got = knn.nearest(q, c, 5, **args)
    assert got._jdf.queryExecution().analyzed().toString().count("Relation") == 1  # one for each block before
    assert ranked(got) == brute(queries, corpus, 5)


def test_cell_search_sends_no_vectors_through_a_shuffle(spark):
    from lorewell.operators import ivf

    rows = _clustered(8, 20)
    c = spark.createDataFrame(rows, "chunk_id long, embedding array<double>")
    index = ivf.build(c, cells=8)
    vectors = np.array([v for _, v in rows])
    import pyarrow as pa

    first = ivf._first_cells(index, vectors, 3)
    block = (pa.array(range(len(rows))), vectors, first, np.full(len(rows), np.nan))
    out = ivf._schema(c.withColumnRenamed("chunk_id", "query_id"), c.schema["chunk_id"].dataType)
    plan = ivf._scored(index, block, np.arange(8), 5, True, True, spark, out)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "CoGroup" not in plan


def test_long_batches_are_counted_in_parts(monkeypatch):
    import pyarrow as pa
    from lorewell.operators import embed

    rnd = np.random.default_rng(2)
    rows = [rnd.integers(0, 16, n).tolist() for n in (0, 5, 900, 3, 0, 70, 1)]
    slots = pa.array(rows, pa.list_(pa.int16()))
    whole = embed.unit_counts(slots, 16)
    longest, count = [], np.bincount
    monkeypatch.setattr(embed, "COUNT_WORDS", 80)
    monkeypatch.setattr(embed.np, "bincount", lambda x, **kw: (longest.append(len(x)), count(x, **kw))[1])
    assert embed.unit_counts(slots, 16).equals(whole)
    assert sorted(longest)[-2] <= 80  # all words at once before
    want = np.stack([count(r, minlength=16) / max(np.linalg.norm(count(r, minlength=16)), 1e-9) if len(r) else np.zeros(16) for r in map(np.array, rows)])
    assert np.allclose(np.stack(whole.to_numpy(zero_copy_only=False)), want, atol=1e-6)


def test_repeated_chunks_take_no_places_in_dense_buckets(spark):
    rnd = np.random.default_rng(9)
    corpus = rnd.normal(size=(60, 16))
    rows = [(i, [float(x) for x in corpus[i]]) for i in range(60)]
    c = spark.createDataFrame(rows + rows, "chunk_id long, embedding array<double>").coalesce(1)
    q = spark.createDataFrame(rows, "query_id long, query_vector array<double>")
    found = knn.nearest(q, c, 5, exclude_same_id=True, lsh=(40, 2)).collect()
    assert len(found) == 300 and len({(r.query_id, r.chunk_id) for r in found}) == 300


def test_a_search_task_never_holds_its_share_of_the_corpus():
    import gc
    import weakref
    from types import SimpleNamespace

    import pyarrow as pa
    from pyspark.sql import types as T

    rnd = np.random.default_rng(2)
    queries, corpus = rnd.normal(size=(40, 8)), rnd.normal(size=(600, 8))
    blocks = [SimpleNamespace(value=(pa.array(range(i, i + 20)), queries[i : i + 20], None)) for i in (0, 20)]
    out = T.StructType([T.StructField(n, T.LongType()) for n in ("query_id", "chunk_id", "score")])
    live, most = [], 0

    def batches():
        nonlocal most
        for i in range(0, 600, 50):
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, 401, 8, dtype=np.int32)), pa.array(corpus[i : i + 50].ravel()))
            batch = pa.RecordBatch.from_arrays([pa.array(range(i, i + 50)), values], ["chunk_id", "v"])
            live.append(weakref.ref(batch))
            yield batch
            del batch, values
            gc.collect()
            most = max(most, sum(r() is not None for r in live))

    right = SimpleNamespace(mapInArrow=lambda run, schema: run)
    run = knn._search(blocks, right, 3, out, None, False)
    found = {(q, c) for b in run(batches()) for q, c in zip(b["query_id"].to_pylist(), b["chunk_id"].to_pylist())}
    best = np.argsort(-(queries @ corpus.T), axis=1)[:, :3]
    assert found == {(q, int(c)) for q in range(40) for c in best[q]}
    assert most <= 2


def test_single_precision_vectors_are_not_copied_to_double():
    import pyarrow as pa

    rnd = np.random.default_rng(9)
    queries = pa.array([list(v) for v in rnd.normal(size=(70, 16))], pa.list_(pa.float32()))
    corpus = pa.array([list(v) for v in rnd.normal(size=(500, 16))], pa.list_(pa.float32()))
    vectors = knn.matrix(queries)
    block = knn.Block(pa.array(range(70)), vectors)
    assert vectors.dtype == np.float32 and block.single is vectors
    ids = pa.array(range(500))
    best = knn.Best(4, ids.type, None, 70)
    knn.score_batch(best, block, knn.matrix(corpus), ids)
    scores = np.round(vectors.astype(float) @ knn.matrix(corpus).astype(float).T, 9)
    want = {(q, int(c), scores[q, c]) for q in range(70) for c in np.argsort(-scores[q], kind="stable")[:4]}
    assert set(zip(*best.prune().to_pydict().values())) == want


def test_first_floors_are_reached_and_keep_most_rows_out(spark):
    import pyarrow as pa

    rnd = np.random.default_rng(31)
    corpus, queries = rnd.normal(size=(6000, 16)).astype(np.float32), rnd.normal(size=(50, 16)).astype(np.float32)
    floors = knn.first_floors(queries, corpus[::4], 6)
    exact = np.round(queries.astype(float) @ corpus[::4].astype(float).T, 9)
    assert (floors <= np.sort(exact, axis=1)[:, -6]).all() and (floors > np.sort(exact, axis=1)[:, -8]).all()
    taken = {}
    for name, start in (("without", np.full(50, -np.inf)), ("with", floors)):
        block, best = knn.Block(pa.array(range(50)), queries), knn.Best(5, pa.int64(), None, 50)
        best.floor, n, take = start.copy(), [0], best.take
        best.take = lambda q, at, score, ids: (n.__setitem__(0, n[0] + len(q)), take(q, at, score, ids))
        for i in range(0, 6000, 500):
            knn.score_batch(best, block, corpus[i : i + 500], pa.array(range(i, i + 500)))
        taken[name] = (n[0], best.prune().to_pydict())
    assert taken["with"][1] == taken["without"][1]
    assert taken["with"][0] < taken["without"][0] / 2
    # Fewer rows than wanted, and vectors that are no numbers, give no floor.
    assert (knn.first_floors(queries, corpus[:5], 6) == -np.inf).all()
    assert knn.first_floors(np.full((1, 16), np.nan, np.float32), corpus, 6)[0] == -np.inf


@pytest.mark.parametrize("repeated", [False, True])
def test_results_are_the_same_with_and_without_floors(spark, monkeypatch, repeated):
    vectors = np.random.default_rng(32).normal(size=(300, 8)).round(3)
    rows = [(int(i % 200 if repeated else i) if i % 17 else None, [float(x) for x in vectors[i % 150]]) for i in range(300)]
    c = spark.createDataFrame(rows, "chunk_id long, embedding array<double>").repartition(5).cache()
    q = c.select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    with_floors, used = knn.with_floors, []
    got = []
    for floors in (lambda *args: used.append(1) or with_floors(*args), lambda left, *_: left):
        monkeypatch.setattr(knn, "with_floors", floors)
        for blocks in ({}, {"broadcast_bytes": 0, "group_bytes": 4096}):
            got.append(sorted(tuple(r) for r in knn.nearest(q, c, 4, exclude_same_id=True, **blocks).collect()))
    assert got[0] == got[2] and got[1] == got[3] and got[0]
    assert len(used) == (0 if repeated else 2)


def test_searches_and_embeddings_get_small_batches(spark, monkeypatch):
    from lorewell.sources import scratch

    batch_bytes, write, before = {}, scratch.freeze, spark.conf.get(scratch.BATCH_SETTING)

    def watch(df, label="frozen", **options):
        batch_bytes[label] = int(spark.conf.get(scratch.BATCH_SETTING))
        return write(df, label, **options)

    monkeypatch.setattr(scratch, "freeze", watch)
    rows = [(f"c{i}", f"u{i}", f"word{i} text", [float(i % 7), float(i % 5), 1.0]) for i in range(40)]
    corpus = spark.createDataFrame(rows, "chunk_id string, doc_uri string, text string, embedding array<float>")
    queries = corpus.select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    found = answering.retrieve(queries, corpus, 3, use_mmr=True, broadcast_bytes=0, group_bytes=256)
    assert found.count() == 120
    assert {label: batch_bytes.get(label) for label in ("nearest", "ranked", "reranked")} == dict.fromkeys(
        ("nearest", "ranked", "reranked"), scratch.BATCH_BYTES
    )
    assert spark.conf.get(scratch.BATCH_SETTING) == before
