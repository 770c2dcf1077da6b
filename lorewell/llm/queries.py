"""The registered queries of the operators, over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.scratch import scratch_path
from . import alignment, decontaminate, divergence, layout, line_dedup, lp_packing, mixing, packing, quality, sharding, simhash, substring_dedup, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


N_SHARDS = 40


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, N_SHARDS).select(
        "doc_id",
        sharding.record_size("text").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lost_words", F.sha2("clean_text", 256).alias("clean_sha256"),
    )


OP2_SQL = f"""
WITH cut AS (
    SELECT doc_id, text, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '{quality.WORD}') AS w
    FROM documents),
base AS (
    SELECT doc_id, text, w, len(w) AS n_words,
           coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
           len(regexp_extract_all(t, '{quality.SYMBOLS}')) AS n_symbols,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{quality.WORD}')) AS lines
    FROM cut),
tri AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
rep AS (
    SELECT doc_id, count(DISTINCT pos) AS n_repeat_words
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM tri WHERE n > 1) GROUP BY doc_id),
line AS (
    SELECT doc_id, no, x, len(regexp_extract_all(x, '{quality.WORD}')) AS lw,
           len(regexp_extract_all(x, '{quality.SYMBOL_RUN}')) AS runs,
           len(regexp_extract_all(x, '{quality.SEPARATOR}')) AS seps
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x,
                 unnest(range(len(string_split(text, chr(10))))) AS no FROM base)),
judged AS (
    SELECT *, lw > 0 AND (
        seps > {quality.SEPARATOR_SHARE} * lw
        OR (lw < {quality.LONG_LINE}
            AND NOT regexp_matches(x, '{quality.SENTENCE_END.replace("'", "''")}'))
        OR runs > {quality.SYMBOL_RUN_SHARE} * lw
        OR (lw <= {quality.NOTICE_WORDS} AND regexp_matches(x, '{quality.STOCK_PHRASES}'))) AS bad
    FROM line),
cleaned AS (
    SELECT doc_id, coalesce(sum(lw) FILTER (bad), 0) AS lost,
           coalesce(string_agg(x, chr(10) ORDER BY no) FILTER (NOT bad), '') AS clean
    FROM judged GROUP BY doc_id),
verdict AS (
    SELECT base.*, coalesce(n_repeat_words, 0) AS n_repeat, coalesce(lost, 0) AS lost, clean,
           n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
    FROM base LEFT JOIN rep USING (doc_id) LEFT JOIN cleaned USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
       CAST(n_repeat AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND lost <= {quality.MAX_LOST} * n_words AS kept,
       CAST(lost AS BIGINT) AS n_lost_words,
       sha256(CASE WHEN text IS NOT NULL THEN clean END) AS clean_sha256
FROM verdict
"""


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs, _table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.col("matches.item_id")))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP3_SQL = r"""
WITH cut AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
item AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
item_window AS (
    SELECT DISTINCT item_id, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS g
    FROM (SELECT item_id, w, least(len(w), 10) AS k,
                 unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p
          FROM item WHERE len(w) > 0)),
doc_window AS (
    SELECT doc_id, p, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS g
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
          FROM cut, (SELECT DISTINCT k FROM item_window))),
found AS (SELECT doc_id, p, k, item_id FROM doc_window JOIN item_window USING (k, g)),
hit AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit
    FROM (SELECT doc_id, unnest(range(p, p + k)) AS pos FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT cut.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM cut LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op4_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.extract_text(_table(spark, sf_dir, "pages")).select("page_id", "url", "text")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup_substrings(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256")
    )


OP5_SQL = f"""
WITH cut AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{quality.WORD}') AS w FROM documents),
win AS (
    SELECT doc_id, p, hash(list_slice(w, p, p + {substring_dedup.K - 1})) AS h,
           md5(array_to_string(list_slice(w, p, p + {substring_dedup.K - 1}), ' ')) AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {substring_dedup.K - 2})) AS p FROM cut)),
later AS (
    SELECT doc_id, p FROM (
        SELECT doc_id, p, row_number() OVER (PARTITION BY h, g ORDER BY doc_id, p) AS n FROM win)
    WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + {substring_dedup.K})) AS pos FROM later),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS pos FROM cut),
kept AS (
    SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.pos) AS words, count(*) AS n
    FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.pos = gone.pos
    GROUP BY word.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM cut LEFT JOIN kept USING (doc_id)
"""


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    records = warc.resolve_revisits(warc.read_archives(spark, path, with_payload=False))
    return records.select(
        F.col("page_id").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long")
    )


OP6_SQL = f"""
WITH page AS (
    SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
digest AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM page),
first AS (SELECT h, min(page_id) AS first_id FROM digest WHERE n >= {warc.REVISIT_BYTES} GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM digest LEFT JOIN first USING (h)
"""


VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY)


def _sized(docs: DataFrame) -> DataFrame:
    """Documents with the number of blank-separated words of the text."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(quality.WORD)), F.lit(0)).cast("long"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _sized(_table(spark, sf_dir, "documents")).select("doc_id", "source", "size")
    mixed = mixing.mix(docs, "size")
    return mixed.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * F.col("repeats")).cast("long").alias("taken"), "repeats",
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed_lines", F.sha2("clean_text", 256).alias("clean_sha256")
    )


OP10_SQL = f"""
WITH line AS (
    SELECT doc_id, source, text, x, no,
           regexp_replace(x, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+\\z', '', 'g') AS trimmed
    FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS x,
                 unnest(range(len(string_split(text, chr(10))))) AS no FROM documents)),
boilerplate AS (
    SELECT trimmed FROM line WHERE trimmed <> ''
    GROUP BY trimmed
    HAVING count(DISTINCT source) + count(DISTINCT CASE WHEN source IS NULL THEN 1 END) >= {line_dedup.MIN_SITES}),
judged AS (SELECT *, trimmed IN (SELECT trimmed FROM boilerplate) AS bad FROM line),
summed AS (
    SELECT doc_id, count(*) FILTER (trimmed <> '') AS n_lines, count(*) FILTER (bad) AS n_removed,
           coalesce(string_agg(x, chr(10) ORDER BY no) FILTER (NOT bad), '') AS clean
    FROM judged GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed_lines,
       sha256(CASE WHEN text IS NOT NULL THEN clean END) AS clean_sha256
FROM documents d LEFT JOIN summed USING (doc_id)
"""


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_quality": op2_quality,
    "op3_decontaminate": op3_decontaminate,
    "op4_layout": op4_layout,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_warc": op6_warc,
    "op7_simhash": op7_simhash,
    "op8_packing": op8_packing,
    "op9_mixing": op9_mixing,
    "op10_line_dedup": op10_line_dedup,
}

ORACLES = {
    "op2_quality": OP2_SQL,
    "op3_decontaminate": OP3_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op6_warc": OP6_SQL,
    "op10_line_dedup": OP10_SQL,
}


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("text", "lang", "source")
    return divergence.audit(docs).select(
        "lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")
    )


OP11_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), '{divergence.UPPER}', '{divergence.LOWER}'),
                              '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
    FROM documents),
occ AS (SELECT rid, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM occ GROUP BY lang, term HAVING count(DISTINCT rid) >= {divergence.MIN_DF}),
vsize AS (SELECT l.lang, count(k.term) AS V FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN kept k USING (lang) GROUP BY l.lang),
groups AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT o.lang, o.source, o.term, count(*) AS c FROM occ o JOIN kept k USING (lang, term) GROUP BY ALL),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.c), 0) AS N, any_value(v.V) AS V
       FROM groups g JOIN vsize v USING (lang) LEFT JOIN cnt c USING (lang, source) GROUP BY g.lang, g.source),
grid AS (
    SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
           1 + (CAST({divergence.SCALE} AS HUGEINT) * (coalesce(c.c, 0) + 1)) // (g.N + g.V) AS p
    FROM gn g JOIN kept k USING (lang) LEFT JOIN cnt c USING (lang, source, term)),
ln AS (SELECT lang, sum(N) AS N, any_value(V) AS V FROM gn GROUP BY lang),
lp AS (
    SELECT k.lang, k.term, 1 + (CAST({divergence.SCALE} AS HUGEINT) * (coalesce(s.c, 0) + 1)) // (l.N + l.V) AS q
    FROM kept k JOIN ln l USING (lang)
    LEFT JOIN (SELECT lang, term, sum(c) AS c FROM cnt GROUP BY ALL) s USING (lang, term)),
fsum AS (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS f
    FROM grid x JOIN grid y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pair AS (
    SELECT a.lang, a.source, b.source AS item, CAST(coalesce(s.f, 0) AS BIGINT) AS value
    FROM gn a JOIN gn b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN fsum s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (
    SELECT g.lang, g.source, g.term AS item, CAST(((g.p - l.q) * (g.p - l.q)) // l.q AS BIGINT) AS value
    FROM grid g JOIN lp l USING (lang, term) WHERE g.c > 0 AND g.p > l.q),
ranked AS (
    SELECT lang, source, part, item, value,
           CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item) ASC) AS INTEGER) AS rank
    FROM (SELECT *, 'pair' AS part FROM pair UNION ALL SELECT *, 'term' AS part FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}
"""

QUERIES["op11_divergence"] = op11_divergence
ORACLES["op11_divergence"] = OP11_SQL


def op13_lp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lp_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset"
    )


QUERIES["op13_lp_packing"] = op13_lp_packing


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES["op12_alignment"] = op12_alignment
