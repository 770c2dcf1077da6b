"""The corpus pipeline: from raw `documents` to shuffled shards of a training mix.

Each stage works on all rows the one before kept, returns the columns of
`documents` (the last one adds its shard and slot) and applies one operator's
decisions:

1. quality_rules: failed lines leave the texts, rejected documents go.
2. near_duplicates: the SimHash operator (operator 7) with its own contract,
   3-word shingles and at most 2 differing bits; of each component one row
   stays, that of the least id (null ids last, then the first stored row).
3. decontamination: documents with a verbatim benchmark passage go.
4. source_mix: documents stay, go or repeat as the source targets ask.
5. sharding: rows in random order over equal shards.

The stages share no state; each can be
run alone on any table with these columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lorewell.llm import decontaminate, mixing, quality, sharding, simhash
from lorewell.llm.scratch import column, free_name, freeze
from lorewell.sources.shipping import ship_package

N_SHARDS = 40

# Not SQL: SimHash components, balanced sampling and random order.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.clean(docs, chars_col="n_chars" if "n_chars" in docs.columns else None)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component stays (`simhash.SHINGLE`, `simhash.RADIUS`).

    Rows are told apart by a stored key, so repeated rows and rows with a null
    id are decided one by one: the row of least (id is null, id, key) stays.
    A null or empty text has fingerprint zero and links like any other; an
    empty table gives an empty table; the input's columns come back unchanged,
    whatever their names.
    """
    ship_package(spark)
    key = free_name("row_key", docs.columns)
    order = F.struct(
        column("doc_id").isNull().alias("no_id"), column("doc_id").alias("id"),
        F.monotonically_increasing_id().alias("row"),
    )
    keyed = freeze(docs.withColumn(key, order), "near-rows")
    found = simhash.near_duplicates(keyed, key, "text", shingle=simhash.SHINGLE, radius=simhash.RADIUS)
    kept = found.filter("id = component_id").select(F.col("id").alias(key))
    return keyed.join(kept, key, "left_semi").select(*[column(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    size = free_name("size", docs.columns)
    words = F.coalesce(F.regexp_count("text", F.lit(quality.WORD)), F.lit(0)).cast("long")
    mixed = mixing.mix(docs.withColumn(size, words), size)
    repeats = mixed.columns[-1]
    return mixing.materialise(mixed, docs.columns, repeats).select(*[column(c) for c in docs.columns])


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return sharding.shard(docs, N_SHARDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("sharding", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
