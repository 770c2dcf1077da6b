"""Logs, payloads and corpora derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lorewell.config import CorpusConfig
from lorewell.schemas import ASSESSMENT_LOG, RANK_CUTOFFS, REQUEST_LOG, rank_metric_name
from lorewell.sources.scratch import scratch_path
from lorewell.sources.tables import spread_small

VERSIONS = ["models:/app/1", "models:/app/2", "models:/app/3"]
# The test pages hold their text in <article> and use h1.
PAGE_CONFIG = CorpusConfig(container=("article", None, None), header="h1")
START_SECONDS = 1704067200

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table with its declared schema, so no file is read to infer it."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


RATING_TYPE = "struct<bool_value:boolean,double_value:double>"


def _hundredth(factor: int) -> str:
    return f"CAST(doc_id * {factor} % 101 AS DOUBLE) / 100"


def request_log(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """One request per document; its text is the output."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return (spread_small(docs) if spread else docs).selectExpr(
        f"""named_struct('request_id', CAST(doc_id AS STRING),
            'messages', CAST(array() AS array<struct<role:string,content:string>>),
            'ts', timestamp_seconds({START_SECONDS} + doc_id * 60)) AS request""",
        """named_struct('app_version_id', concat('models:/app/', CAST(doc_id % 3 + 1 AS STRING)),
            'latency_ms', n_chars * 0.25D) AS trace""",
        "text AS output",
    )


def _rating(verdict: str = "NULL", score: str = "NULL") -> str:
    return f"named_struct('bool_value', CAST({verdict} AS BOOLEAN), 'double_value', CAST({score} AS DOUBLE))"


def _assessments(df: DataFrame, step: str, source: str, column: str, ratings: dict[str, str]) -> DataFrame:
    """Assessment rows with the given ratings in `column`; the rest is null."""
    fields = []
    for f in ASSESSMENT_LOG[column].dataType["ratings"].dataType.names:
        fields.append(f"'{f}', " + ratings.get(f, f"CAST(NULL AS {RATING_TYPE})"))
    halves = {
        c: f"CAST(NULL AS {ASSESSMENT_LOG[c].dataType.simpleString()}) AS {c}"
        for c in ("text_assessment", "retrieval_assessment")
    }
    halves[column] = f"named_struct('ratings', named_struct({', '.join(fields)})) AS {column}"
    return df.selectExpr(
        "CAST(doc_id AS STRING) AS request_id",
        f"'{step}' AS step_id",
        f"named_struct('type', '{source}') AS source",
        *halves.values(),
        f"timestamp_seconds({START_SECONDS} + doc_id * 60) AS ts",
    )


def assessment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency and token rows per document, verdict and retrieval rows per label.

    Some verdicts and some scores are missing, so that the null rules matter.
    """
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    texts = spread_small(docs.select("doc_id", "text"))
    latency = {"latency": _rating(score="n_chars * 0.25D")}
    tokens = {"token_count": _rating(score=r"regexp_count(text, '\\S+')")}
    verdicts = {
        "harmful": _rating(
            "CASE WHEN doc_id % 11 <> 0 THEN toxic = 1 END",
            f"CASE WHEN doc_id % 7 <> 0 THEN {_hundredth(37)} END",
        ),
        "relevant_to_question_and_context": _rating(
            "CASE WHEN doc_id % 5 <> 0 THEN quality = 1 END", _hundredth(53)
        ),
        "faithful_to_context": _rating("doc_id * 29 % 101 >= 50", _hundredth(29)),
    }
    ranks = {
        rank_metric_name(metric, k): _rating(
            score=f"CASE WHEN doc_id % {k + 1} <> 0 THEN {_hundredth(base + k)} END"
        )
        for k in RANK_CUTOFFS
        for metric, base in (("recall", 31), ("precision", 41), ("ndcg", 61))
    }
    return (
        _assessments(docs, "s0", "automatic", "text_assessment", latency)
        .unionByName(_assessments(texts, "s1", "automatic", "text_assessment", tokens))
        .unionByName(_assessments(labels, "s2", "human", "text_assessment", verdicts))
        .unionByName(_assessments(labels, "s3", "automatic", "retrieval_assessment", ranks))
    )


_written: dict[tuple[str, str], tuple[str, str]] = {}


def log_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both logs as stored tables, written once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        paths = scratch_path(spark, "request-log"), scratch_path(spark, "assessment-log")
        request_log(spark, sf_dir, spread=True).write.parquet(paths[0])
        assessment_log(spark, sf_dir).write.parquet(paths[1])
        _written[key] = paths
    request_path, assessment_path = _written[key]
    return (
        spark.read.schema(REQUEST_LOG).parquet(request_path),
        spark.read.schema(ASSESSMENT_LOG).parquet(assessment_path),
    )


def multi_version_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's request under all three versions."""
    version = F.explode(F.array(*[F.lit(v) for v in (1, 2, 3)])).alias("v")
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars", version)
    return rows.select(
        F.struct(F.col("doc_id").cast("string").alias("request_id")).alias("request"),
        F.struct(
            F.concat(F.lit("models:/app/"), F.col("v").cast("string")).alias("app_version_id"),
            (F.col("n_chars") + F.col("v")).cast("double").alias("latency_ms"),
        ).alias("trace"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_small(table(spark, sf_dir, "pages")).select(
        F.col("url").alias("doc_uri"), F.col("html").alias("html_content")
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_small(table(spark, sf_dir, "documents").select("doc_id", "text"))


def text_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("doc_uri"),
        F.col("text").alias("content"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), "embedding", "label"
    )


def vector_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test vectors as the chunks of the documents with the same number."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    named = vectors(spark, sf_dir).select("chunk_id", "embedding").join(docs, "chunk_id")
    uri = F.concat(F.lit("doc/"), F.col("chunk_id").cast("string"))
    return named.select("chunk_id", uri.alias("doc_uri"), "text", "embedding")


def as_payloads(events: DataFrame) -> DataFrame:
    """Events as logged endpoint calls: purchases are feedback, the rest requests."""
    feedback = F.col("event_type") == "purchase"
    request_body = F.struct(
        F.concat(F.lit("models:/app/"), (F.col("user_id") % 3 + 1).cast("string")).alias("app_version_id"),
        F.array(
            F.struct(F.lit("user").alias("role"), F.concat_ws(" ", "event_type", "props").alias("content"))
        ).alias("messages"),
    )
    verdict = F.struct(
        (F.col("value") > 20).alias("bool_value"), F.col("value").alias("double_value")
    )
    feedback_body = F.struct(
        F.lit("feedback").alias("step_id"),
        F.lit("human").alias("source"),
        F.struct(verdict.alias("harmful")).alias("ratings"),
    )
    return events.select(
        F.when(feedback, F.concat(F.lit("u"), F.col("user_id").cast("string")))
        .otherwise(F.concat(F.lit("r"), F.col("event_id").cast("string")))
        .alias("request_id"),
        F.when(feedback, F.lit("assessment")).otherwise(F.lit("request")).alias("kind"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        (F.col("value") * 10).alias("latency_ms"),
        F.when(feedback, F.to_json(feedback_body)).otherwise(F.to_json(request_body)).alias("request"),
        F.to_json(F.struct(F.col("props").alias("output"))).alias("response"),
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of three micro-batches, each of as many files as the table has splits."""
    path = scratch_path(spark, "event-files")
    events = table(spark, sf_dir, "events")
    files = max(1, events.rdd.getNumPartitions())
    events.repartition(3 * files).write.parquet(path)
    return spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", files).parquet(path)
