"""Source divergence audit against a plain Python count of every term and pair."""

import re

from lorewell.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_df=3, top=200):
    docs = [((l or ""), (s or ""), TERM.findall((t or "").translate(str.maketrans(divergence.UPPER, divergence.LOWER)))) for t, l, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = {}
        for _, _, ts in mine:
            for t in set(ts):
                df[t] = df.get(t, 0) + 1
        kept = sorted(t for t, n in df.items() if n >= min_df)
        V = len(kept)
        sources = sorted({d[1] for d in mine})
        counts = {s: {t: 0 for t in kept} for s in sources}
        for _, s, ts in mine:
            for t in ts:
                if t in counts[s]:
                    counts[s][t] += 1

        def p(c, n):
            return 1 + (10**9 * (c + 1)) // (n + V)

        lang_count = {t: sum(counts[s][t] for s in sources) for t in kept}
        lang_n = sum(lang_count.values())
        for s in sources:
            n = sum(counts[s].values())
            ranked = []
            for o in sources:
                if o != s:
                    m = sum(counts[o].values())
                    v = sum((p(counts[s][t], n) - p(counts[o][t], m)) ** 2 // p(counts[o][t], m) for t in kept) if V else 0
                    ranked.append(("pair", o, v))
            for t in kept:
                a, q = p(counts[s][t], n), p(lang_count[t], lang_n)
                if counts[s][t] > 0 and a > q:
                    ranked.append(("term", t, (a - q) ** 2 // q))
            for part in ("pair", "term"):
                these = sorted((r for r in ranked if r[0] == part), key=lambda r: (-r[2], r[1].encode()))
                for k, (_, item, v) in enumerate(these, 1):
                    if part == "pair" or k <= top:
                        out.append((lang, s, part, item, v, k))
    return sorted(out)


ROWS = [
    ("The cat sat on the mat. Über café!", "en", "a"),
    ("the cat and the dog", "en", "a"),
    ("A dog; a CAT; the end", "en", "b"),
    ("cat cat cat dog the", "en", None),
    (None, "en", "b"),
    ("", None, "x"),
    ("Le chat et le chien", "fr", "a"),
    ("le chat le chat", "fr", "a"),
    ("le chien, le chat", "fr", "a"),
    ("cat cat cat dog the", "en", None),
]


def test_audit_against_brute_force(spark):
    docs = spark.createDataFrame(ROWS, "text string, lang string, source string")
    got = sorted(tuple(r) for r in divergence.audit(docs).collect())
    assert got == brute(ROWS)
    assert any(r[2] == "pair" and r[4] > 0 for r in got) and any(r[2] == "term" for r in got)


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(empty).count() == 0
    clash = spark.createDataFrame([(t, l, s, 1, 2) for t, l, s in ROWS], "text string, lang string, source string, value long, rank long")
    assert sorted(tuple(r) for r in divergence.audit(clash).collect()) == brute(ROWS)


def test_one_lang_without_kept_terms(spark):
    rows = [("alpha", "xx", "a"), ("beta", "xx", "b"), (None, "xx", None)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = sorted(tuple(r) for r in divergence.audit(docs).collect())
    assert got == brute(rows) and all(r[4] == 0 and r[2] == "pair" for r in got) and len(got) == 6


def test_empty_language_keeps_its_groups(spark):
    rows = [("alpha beta", None, "a"), ("alpha beta", "", "b"), ("alpha beta", None, "b"), ("alpha", "", None)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = sorted(tuple(r) for r in divergence.audit(docs).collect())
    assert got == brute(rows) and {r[0] for r in got} == {""} and len([r for r in got if r[2] == "pair"]) == 6


def test_the_vocabulary_does_not_pass_through_python(spark, monkeypatch):
    from pyspark.ml.feature import CountVectorizerModel

    def never(self):
        raise AssertionError("the vocabulary was fetched")

    monkeypatch.setattr(CountVectorizerModel, "vocabulary", property(never))
    rows = [("en", s, ["a", "b", s]) for s in ("x", "y", "z")] + [("", "x", [])]
    sums, sizes = divergence.group_sums(spark.createDataFrame(rows, "lang string, source string, terms array<string>"))
    assert sorted(tuple(r) for r in sums.collect()) == [("en", s, t, 1) for s in "xyz" for t in "ab"]
    assert sorted(tuple(r) for r in sizes.collect()) == [("", 0), ("en", 2)]


def test_counts_beyond_64_bit_products_stay_exact(spark):
    rows = [(c, n, v) for c in (0, 5, 8_999_999_999, 9_000_000_000, 4 * 10**15) for n, v in ((4 * 10**15, 7), (1, 0), (10**10, 3)) if c <= n]
    got = spark.createDataFrame(rows, "c long, n long, v long").select("c", "n", "v", divergence._p("c", "n", "v").alias("p")).collect()
    assert all(r.p == 1 + 10**9 * (r.c + 1) // (r.n + r.v) for r in got if r.p) and len(got) == len(rows)


def test_many_equal_values_at_the_last_rank_and_terms_by_number(spark):
    # 300 terms of equal value in each source: ranks fall to the items, and no vector passes through JSON.
    rows = [(" ".join(f"{s}{i:03d}" for i in range(300)), "en", s) for s in "ab" for _ in range(3)]
    rows += [("Straße ÉTÉ zeta ABC abc", "de", "c")] * 3
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    out = divergence.audit(docs)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows)
    assert "to_json" not in out._jdf.queryExecution().toString()
