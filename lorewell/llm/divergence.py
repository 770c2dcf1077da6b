"""Source divergence audit: how far each source's term distribution lies from
the other sources of its language and from the language as a whole.

Method. Per language, Spark ML's `CountVectorizer` with `minDF` documents and
the largest vocabulary size keeps every term found in at least `minDF`
documents and turns each document into an exact sparse count vector. Sparse
vectors are summed per (lang, source) group, Summarizer-style but sparse: the
vector's indices and values are read natively (as the struct it is stored as),
exploded and summed by a map-side combined aggregation, so a group never holds
a dense vector. Terms travel as their numbers in the vocabulary; only the rows
of the result look up their texts. Pairs of sources are evaluated sparsely, on classes of counts: terms
of one count in a group share their p, so a pair's sum needs the joint
histogram of counts of the terms both sources hold (a self-join on the term,
each two sources once, aggregated before its shuffle), each source's own histogram for the terms
only it holds, and one constant for the terms neither holds.

Arithmetic is exact (decimal products, integer division):
    p = 1 + floor(SCALE * (count + 1) / (N + V))
    f = floor((p - q)^2 / q)
with N the group's sum of kept counts and V the language's number of kept
terms. Part `pair`: each other source of the language, value the sum of f over
all V terms (0 when V = 0). Part `term`: each kept term with count > 0 in the
group and p > q, q the language's p, value f, first `top` ranks only. Ranks go
from 1 per (lang, source, part), value descending, item ascending in UTF-8
byte order (ties of both keep equal items apart, so ranks are unique).

Edge cases: null text, lang or source read as ''. A group whose documents have
no kept term still gets a `pair` row for each other source (and no `term`
rows). A language with a single source gives no `pair` rows. Empty and very
long texts are cut by one regular expression, no prefix is taken. Repeated rows
count as often as they occur. An empty table gives an empty result. The input
may carry any other columns; only the three named ones are read.

Scale: the vocabulary is the CountVectorizer model's own state and is held on
the driver while the model is built and applied (one model per language, the
languages are collected: a short list). Every other table is a DataFrame.
"""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import scratch_path
from .scratch import column, freeze

# Fixed values of the contract: term pattern, case folding, scale, ranks.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SCALE = 1_000_000_000
MIN_DF = 3
TOP_TERMS = 200
VOCAB_SIZE = 2**31 - 1

# Counts below this are multiplied by SCALE in 64 bits, larger ones as decimals.
_SMALL = 9_000_000_000

# The ASCII characters outside terms, by the rule of TERM.
_DELIMITERS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    """The terms of a text: maximal runs matching TERM, A-Z lower-cased.

    Texts of ASCII characters are lower-cased as a whole, others by a map of
    A-Z; a split at runs of other characters then gives the terms.
    """
    whole = F.coalesce(text, F.lit(""))
    folded = F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))
    return F.array_remove(F.split(folded, _DELIMITERS), "")


def _p(count: str, total: str, vocab: str) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + vocab)), exactly; columns by name."""
    return F.expr(
        f"CASE WHEN {total} + {vocab} > 0 THEN 1 + CASE WHEN {count} < {_SMALL}L "
        f"THEN ({SCALE}L * ({count} + 1L)) div ({total} + {vocab}) "
        f"ELSE (CAST({SCALE} AS DECIMAL(38,0)) * CAST({count} + 1 AS DECIMAL(38,0))) div CAST({total} + {vocab} AS DECIMAL(38,0)) END END"
    )


def _f(p: str, q: str) -> Column:
    """floor((p - q)^2 / q), exactly; columns by name. p and q are 1 to SCALE + 1, so 64 bits hold the square."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def group_sums(base: DataFrame, min_df: int = MIN_DF) -> tuple[DataFrame, DataFrame]:
    """Sparse kept-term counts per (lang, source, term), and V per lang."""
    sums, vocab_sizes, words = numbered_sums(base, min_df)
    return sums.join(words, ["lang", "idx"]).select("lang", "source", "term", "count"), vocab_sizes


def numbered_sums(base: DataFrame, min_df: int = MIN_DF) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts per (lang, source, idx), V per lang, and the terms (lang, idx, term), stored.

    `base` has columns lang, source, terms (array of strings), all non-null.
    """
    spark = base.sparkSession
    langs = [r[0] for r in base.select("lang").distinct().orderBy("lang").collect()]
    sums, words, sizes = None, None, []
    for lang in langs:
        part = base.filter(F.col("lang") == F.lit(lang))
        model = CountVectorizer(
            inputCol="terms", outputCol="vec", minDF=float(min_df), vocabSize=VOCAB_SIZE
        ).fit(part)
        # The vocabulary is read back from the stored model, not through Python.
        path = scratch_path(spark, "divergence-model")
        model.write().save(path)
        saved = spark.read.parquet(f"{path}/data")
        sizes.append((lang, saved.select(F.size("vocabulary")).first()[0]))
        if not sizes[-1][1]:
            continue
        terms_of = saved.select(F.lit(lang).alias("lang"), F.posexplode("vocabulary").alias("idx", "term"))
        cells = (
            model.transform(part)
            .select("source", F.unwrap_udt("vec").alias("v"))
            .select("source", F.inline(F.arrays_zip(F.col("v.indices").alias("idx"), F.col("v.values").alias("n"))))
            .groupBy("source", "idx")
            .agg(F.sum(F.col("n").cast("long")).alias("count"))
            .select(F.lit(lang).alias("lang"), "source", "idx", "count")
        )
        # Stored, so that only one language's model is alive.
        cells = freeze(cells, "divergence-cells")
        sums = cells if sums is None else sums.unionByName(cells)
        words = terms_of if words is None else words.unionByName(terms_of)
    vocab_sizes = spark.createDataFrame(sizes, "lang string, V long")
    if sums is None:
        sums = spark.createDataFrame([], "lang string, source string, idx int, count long")
        words = spark.createDataFrame([], "lang string, idx int, term string")
    return sums, vocab_sizes, words


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    min_df: int = MIN_DF, top: int = TOP_TERMS,
) -> DataFrame:
    """Rows (lang, source, part, item, value long, rank int); see the module."""
    spark = docs.sparkSession
    base = docs.select(
        F.coalesce(column(lang_col), F.lit("")).alias("lang"),
        F.coalesce(column(source_col), F.lit("")).alias("source"),
        terms(column(text_col)).alias("terms"),
    )
    # Stored by language, so that each language's model reads its own files.
    path = scratch_path(spark, "divergence-terms")
    base.write.partitionBy("lang").parquet(path)
    # An empty language is written as the default partition and read as null.
    base = spark.read.schema(base.schema).parquet(path).withColumn("lang", F.coalesce("lang", F.lit("")))
    cells, vocab, words = numbered_sums(base, min_df)
    totals = cells.groupBy("lang", "source").agg(F.sum("count").alias("N"))
    # A group's number stands for its language and source in the joins.
    groups = freeze(
        base.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
        .join(vocab, "lang", "left")
        .select("lang", "source", F.coalesce("N", F.lit(0)).alias("N"), F.coalesce("V", F.lit(0)).alias("V"))
        .withColumn("g", F.monotonically_increasing_id()),
        "divergence-groups",
    )
    cells = cells.join(groups.select("lang", "source", "g"), ["lang", "source"]).select("lang", "idx", "g", "count")

    # Part `pair`: every ordered pair of sources of a language (the contract's output).
    # Terms of equal count in a group have equal p, so each pair's sum runs
    # over classes of counts: joint classes of the terms both sources hold,
    # each source's own classes for terms only it holds, and one constant
    # for the terms neither holds. Nothing grows with pairs times terms.
    left = groups.select("lang", "source", "g", F.col("N").alias("N1"), "V", _p("0", "N", "V").alias("p01"))
    right = groups.select("lang", F.col("source").alias("other"), F.col("g").alias("o"), F.col("N").alias("N2"), _p("0", "N", "V").alias("p02"))
    pairs = freeze(left.join(right, "lang").filter("g != o"), "divergence-pairs")
    keys = ["g", "o"]
    hist = freeze(cells.groupBy("g", F.col("count").alias("c")).agg(F.count(F.lit(1)).alias("h")), "divergence-hist")
    mine = cells.select("lang", "idx", "g", F.col("count").alias("cs"))
    theirs = cells.select("lang", "idx", F.col("g").alias("o"), F.col("count").alias("co"))
    once = freeze(
        mine.join(theirs, ["lang", "idx"]).filter("g < o")
        .groupBy(*keys, "cs", "co").agg(F.count(F.lit(1)).alias("j")),
        "divergence-joint",
    )
    turned = once.select(F.col("o").alias("g"), F.col("g").alias("o"), F.col("co").alias("cs"), F.col("cs").alias("co"), "j")
    joint = once.unionByName(turned)
    both = (
        joint.join(pairs, keys)
        .withColumn("pa", _p("cs", "N1", "V")).withColumn("pb", _p("co", "N2", "V"))
        .select(*keys, (F.col("j") * _f("pa", "pb")).alias("x"), F.col("j").alias("n"))
    )
    rows_of = freeze(joint.groupBy(*keys, F.col("cs").alias("c")).agg(F.sum("j").alias("shared")), "divergence-shared")
    only_mine = (
        pairs.join(hist, "g").join(rows_of, [*keys, "c"], "left")
        .withColumn("pa", _p("c", "N1", "V"))
        .select(*keys, ((F.col("h") - F.coalesce("shared", F.lit(0))) * _f("pa", "p02")).alias("x"), F.lit(0).alias("n"))
    )
    cols_of = rows_of.select(F.col("o").alias("g"), F.col("g").alias("o"), "c", "shared")
    only_theirs = (
        pairs.join(hist.withColumnRenamed("g", "o"), "o").join(cols_of, [*keys, "c"], "left")
        .withColumn("pb", _p("c", "N2", "V"))
        .select(*keys, ((F.col("h") - F.coalesce("shared", F.lit(0))) * _f("p01", "pb")).alias("x"), F.lit(0).alias("n"))
    )
    sizes = hist.groupBy("g").agg(F.sum("h").alias("size"))
    seen = both.unionByName(only_mine).unionByName(only_theirs).groupBy(*keys).agg(
        F.sum("x").alias("f_seen"), F.sum("n").alias("shared")
    )
    counted = (
        pairs.join(seen, keys, "left")
        .join(sizes.withColumnRenamed("size", "size1"), "g", "left")
        .join(sizes.select(F.col("g").alias("o"), F.col("size").alias("size2")), "o", "left")
    )
    absent = F.col("V") - F.coalesce("size1", F.lit(0)) - F.coalesce("size2", F.lit(0)) + F.coalesce("shared", F.lit(0))
    pair_rows = counted.select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"),
        F.when(F.col("V") == 0, F.lit(0).cast("decimal(38,0)")).otherwise(
            F.coalesce("f_seen", F.lit(0)) + absent * _f("p01", "p02")
        ).cast("long").alias("value"),
    )

    # Part `term`: the group's terms above the language's own distribution. Only rows
    # whose value ranks high enough, with all of an equal value, look up their terms.
    lang_totals = groups.groupBy("lang").agg(F.sum("N").alias("LN"), F.first("V").alias("LV"))
    rated = (
        cells.withColumn("lc", F.sum("count").over(Window.partitionBy("lang", "idx")))
        .join(groups.select("g", "source", "N", "V"), "g").join(lang_totals, "lang")
        .withColumn("p", _p("count", "N", "V")).withColumn("q", _p("lc", "LN", "LV"))
        .filter("count > 0 AND p > q")
        .select("lang", "source", "g", "idx", _f("p", "q").alias("value"))
    )
    high = Window.partitionBy("g").orderBy(F.col("value").desc())
    near = rated.withColumn("_r", F.rank().over(high)).filter(F.col("_r") <= top)
    term_rows = near.join(words, ["lang", "idx"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value"
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(
        F.col("value").desc(), F.encode("item", "UTF-8").asc()
    )
    ranked = pair_rows.unionByName(term_rows).withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))
