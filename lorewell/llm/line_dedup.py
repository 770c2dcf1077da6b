"""Cross-site line deduplication, with built-in expressions only.

Lines (blank ends trimmed) are keyed by a 64-bit hash and their length. Sites
are counted by HyperLogLog sketches that merge in a map-side combined
aggregation. Lines whose estimate lies near the threshold get an exact distinct
count of sites; lines on `min_sites` or more sites are boilerplate and leave all
texts. Removed positions are gathered per distinct text (a bounded set: the
lines of one text) and joined to the documents through stored tables, which
adaptive execution can split at frequent texts.

Null texts have no lines and stay null. A null site is a site of its own. Blank
lines are never removed. Repeated rows are treated alike. Clashing column names
keep the caller's column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import let
from .scratch import column, free_name, freeze

MIN_SITES = 8
LG_K = 12
# Six standard errors of a sketch with 2**12 registers, and one site.
MARGIN = 6 * 1.04 / 2 ** (LG_K / 2)
BLANK_ENDS = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z"


def _key(line: Column) -> Column:
    trimmed = F.regexp_replace(line, BLANK_ENDS, "")
    return let(trimmed, lambda t: F.struct(F.xxhash64(t).alias("h"), F.char_length(t).alias("n")))


def _keys(text: Column) -> Column:
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), _key)


def boilerplate_lines(
    docs: DataFrame, text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """(h, n) of the lines found on at least `min_sites` sites."""
    site = column(site_col).cast("string")
    lines = docs.select(
        F.explode(F.array_distinct(_keys(column(text_col)))).alias("key"),
        F.coalesce(F.concat(F.lit("s"), site), F.lit("-")).alias("site"),
    ).select("key.h", "key.n", "site").filter("n > 0")
    sketched = lines.groupBy("h", "n").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"))
    low, high = min_sites * (1 - MARGIN) - 1, min_sites * (1 + MARGIN) + 1
    likely = freeze(sketched.filter(F.col("sites") >= low), "line-sites")
    near = likely.filter(F.col("sites") <= high).select("h", "n")
    exact = lines.join(near, ["h", "n"], "left_semi").distinct().groupBy("h", "n").agg(F.count(F.lit(1)).alias("sites"))
    sure = likely.filter(F.col("sites") > high).select("h", "n")
    return freeze(exact.filter(F.col("sites") >= min_sites).select("h", "n").unionByName(sure), "boilerplate")


def dedup_lines(
    docs: DataFrame, text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """`docs` with `clean_text`, `n_lines` (lines with a word) and `n_removed_lines`."""
    text = column(text_col)
    found = boilerplate_lines(docs, text_col, site_col, min_sites)
    places = docs.select(F.xxhash64(text).alias("t"), F.posexplode(_keys(text)).alias("place", "key"))
    hits = places.select("t", "place", "key.h", "key.n").filter("n > 0").join(found, ["h", "n"], "left_semi")
    removed = freeze(
        hits.groupBy("t").agg(F.collect_set("place").alias("gone")), "removed-lines"
    )
    taken = list(docs.columns)
    names = {}
    for name in ("clean_text", "n_lines", "n_removed_lines", "text_key", "gone"):
        names[name] = free_name(name, taken)
        taken.append(names[name])
    removed = removed.select(F.col("t").alias(names["text_key"]), F.col("gone").alias(names["gone"]))
    # Always a sort-merge join: the removed positions grow with the documents.
    joined = docs.join(removed.hint("merge"), F.xxhash64(text) == column(names["text_key"]), "left")
    gone = column(names["gone"])
    lines = F.split(text, "\n")
    kept = let(
        lines,
        lambda x: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), gone), lambda i: F.get(x, i)), "\n"
        ),
    )
    with_words = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return joined.withColumns({
        names["clean_text"]: F.when(gone.isNull(), text).otherwise(kept),
        names["n_lines"]: with_words.cast("long"),
        names["n_removed_lines"]: F.when(gone.isNull(), F.lit(0)).otherwise(F.size(gone)).cast("long"),
    }).select(*[column(c) for c in (*docs.columns, names["clean_text"], names["n_lines"], names["n_removed_lines"])])
