import numpy as np
import xxhash
from llm_help import lower, words

from lorewell.llm import components, simhash


def fingerprint(text):
    w = [x.encode() for x in words(lower(text))]
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute(rows):
    """(id, text) -> list of (id, fingerprint, component id)."""
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = least.setdefault(find(i), doc)
        least[find(i)] = min((x for x in (known, doc) if x is not None), default=None)
    return [(doc, p, least[find(i)]) for i, ((doc, _), p) in enumerate(zip(rows, prints))]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_matches_brute_force(spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    got = [(r["id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(odd_docs).collect()]
    assert order(got) == order(brute(rows))


def test_links_in_small_tiles(spark):
    """Several tiles a cell give the same components as all pairs."""
    draw = np.random.default_rng(5)
    seeds = draw.integers(0, 2**63, 40, dtype=np.int64)
    flips = [int(s) ^ (1 << int(a)) ^ (1 << int(b)) for s in seeds for a, b in draw.integers(0, 63, (6, 2))]
    prints = sorted({int(s) for s in seeds} | set(flips))
    nodes = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = components.star_components(simhash.links(nodes, "fp", tile=1)).collect()
    root = {p: p for p in prints} | {r["node"]: r["root"] for r in found}
    want = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= 2 and want[b] < want[a]:
                    want[a], changed = want[b], True
    assert root == want


def test_keep_one(spark, odd_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    want = [doc for doc, _, least in brute(rows) if doc is None or doc == least]
    assert order([(r["doc_id"],) for r in kept.select("doc_id").collect()]) == order([(d,) for d in want])


def test_empty(spark, odd_docs):
    empty = odd_docs.limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.star_components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
