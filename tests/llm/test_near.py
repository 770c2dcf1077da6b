"""Near copies against all pairs of shingle sets."""

import random

import corpus_pipeline
from llm_help import lower, words

from lorewell.llm import near


def shingles(text, k=5):
    w = words(lower(text))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def linked(texts):
    """The least index each text is connected with, by 5 |a & b| >= 4 |a | b|."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def near_copies(seed=3, bases=12):
    """Texts and copies with a changed start or end, of a similarity around and over 0.8."""
    draw = random.Random(seed)
    texts, alike = [], []
    for b in range(bases):
        base = [f"w{draw.randint(0, 9999)}" for _ in range(204)]
        texts.append(" ".join(base))
        for share in (0.79, 0.80, 0.82, 0.86, 0.90, 0.95):
            # k of the 200 shingles go and k others come: (200 - k) / (200 + k) >= share.
            k = int(200 * (1 - share) / (1 + share) + 1e-9) + (share == 0.79)
            new = [f"n{draw.randint(0, 9999)}" for _ in range(k)]
            texts.append(" ".join(base[:-k] + new if draw.random() < 0.5 else new + base[k:]))
            alike.append((b * 7, len(texts) - 1, share))
    return texts, alike


def test_copies_at_080_to_095_are_removed_in_the_stage(spark):
    texts, alike = near_copies()
    sets = [shingles(t) for t in texts]
    found = [len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b, _ in alike]
    assert all((s >= 0.8) == (share > 0.79) and s > 0.77 for s, (_, _, share) in zip(found, alike))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    root = linked(texts)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root))
    assert len(set(root)) < len(texts)


def test_components_match_all_pairs(spark, odd_docs):
    texts = [r["text"] for r in odd_docs.select("text").collect()] + near_copies(8, 4)[0]
    # A common passage, texts mostly made of it, and a chain whose ends are far apart.
    draw = random.Random(2)
    own = lambda n: [f"o{draw.randint(0, 9999)}" for _ in range(n)]
    passage, chain = own(100), own(300)
    texts += [" ".join(own(draw.randint(5, 60)) + passage + own(draw.randint(0, 20))) for _ in range(30)]
    texts += [" ".join(chain[i : i + 200]) for i in range(0, 100, 15)]
    rows = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    got = {r["row"]: r["root"] for r in near.components_of(rows).collect()}
    want = linked(texts)
    assert len(got) == len(texts) and sum(r != i for i, r in enumerate(want)) > 30
    assert len(set(zip(want, (got[i] for i in range(len(texts)))))) == len(set(want)) == len(set(got.values()))


def test_one_row_of_each_component_stays(spark):
    draw = random.Random(6)
    a, b, c = (" ".join(f"{x}{draw.randint(0, 9999)}" for _ in range(60)) for x in "abc")
    rows = [
        (None, a, 1), (None, a, 2),  # copies without an id
        (5, b, 3), (5, b, 4), (None, b, 5),  # the kept id repeated
        (7, b, 6), (7, c, 7),  # one id: a copy, and a text of its own
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long").coalesce(1)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["row"] for r in kept.collect()) == [1, 3, 7]
