import random

import pytest

from lorewell.llm import mixing
from lorewell.llm.mixing import Flight


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Targets by handing out what is above the cap again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    open_, left, out = set(names), share * sum(sizes.values()), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > cap * sizes[s]}
        for s in full or open_:
            out[s] = cap * sizes[s] if full else left * weight[s] / total
        left -= sum(out[s] for s in full)
        open_ -= full or open_
    return out


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(4)
    rows = []
    for i in range(3000):
        source = draw.choice(["a", "a", "a", "é", "b", "B", "z", "tiny", None])
        rows.append((i, source, draw.choice([0, 1, 5, 40, 40, 300]) if source != "zero" else 0, i))
    rows += [(5000 + i, "zero", 0, i) for i in range(5)] + [(6000, "a", None, 1), rows[7], rows[7], (None, None, 12, 1)]
    return spark.createDataFrame(rows, "doc_id long, source string, size long, repeats long").repartition(5)


def by_source(rows):
    out = {}
    for r in rows:
        out.setdefault(r["source"], []).append(r)
    return out


@pytest.mark.parametrize("block_units", [mixing.BLOCK_UNITS, 50])
def test_targets_are_met(spark, docs, block_units):
    mixed = mixing.mix(docs, "size", block_units=block_units)
    assert mixed.columns == [*docs.columns, "source_size", "target", "repeats_"]
    rows = mixed.collect()
    assert len(rows) == docs.count()
    sources = by_source(rows)
    want = targets({s: sum(r["size"] or 0 for r in rs) for s, rs in sources.items()})
    for source, rs in sources.items():
        size = sum(r["size"] or 0 for r in rs)
        assert all(r["source_size"] == size and r["target"] == pytest.approx(want[source]) for r in rs)
        taken = sum((r["size"] or 0) * r["repeats_"] for r in rs)
        assert abs(taken - want[source]) <= 300
        assert all(0 <= r["repeats_"] <= 2 for r in rs)
        if size:
            assert abs(sum(r["repeats_"] for r in rs) - want[source] / size * len(rs)) <= 3


def test_reruns_agree_whatever_the_layout(docs):
    first = sorted(map(str, mixing.mix(docs, "size", block_units=200).collect()))
    again = sorted(map(str, mixing.mix(docs.repartition(2), "size", block_units=200).collect()))
    assert first == again


def test_materialise(spark, docs):
    mixed = mixing.mix(docs, "size")
    copies = mixing.materialise(mixed, docs.columns, "repeats_")
    assert copies.columns == docs.columns
    assert copies.count() == mixed.agg({"repeats_": "sum"}).first()[0]


def test_flight_keeps_both_totals():
    draw = random.Random(2)
    for trial in range(50):
        flight, p, size = Flight(("s", trial), 1), [], []
        done = {}
        for row in range(draw.randint(1, 200)):
            p.append(draw.random() * 0.98 + 0.01)
            size.append(float(draw.choice([0, 1, 3, 3, 1000])))
            done.update(flight.add(row, p[-1], size[-1]))
        now = {**done, **{row: value for row, value, _ in flight.units}}
        assert len(now) == len(p) and len(flight.units) <= 2
        assert sum(now.values()) == pytest.approx(sum(p))
        assert sum(v * size[r] for r, v in now.items()) == pytest.approx(sum(a * b for a, b in zip(p, size)))


def test_inclusion_follows_the_probability():
    hits = 0
    for seed in range(400):
        flight, done = Flight(("s",), seed), {}
        for row in range(20):
            done.update(flight.add(row, 0.3, float(row % 7)))
        done.update(flight.land())
        hits += done[5]
    assert 80 < hits < 165


def test_empty(docs):
    assert mixing.mix(docs.limit(0), "size").count() == 0
