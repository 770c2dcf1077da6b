"""Logged endpoint calls to request and assessment logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..schemas import MESSAGES, PAYLOAD, RETRIEVAL_RATINGS, TEXT_RATINGS

# Fixed values of the payload column `kind` and of the outcome.
REQUEST = "request"
ASSESSMENT = "assessment"
REJECT = "reject"

CORRUPT = "_corrupt"
REQUEST_BODY = T.StructType(
    [
        T.StructField("app_version_id", T.StringType()),
        T.StructField("messages", MESSAGES),
        T.StructField(CORRUPT, T.StringType()),
    ]
)
RESPONSE_BODY = T.StructType(
    [T.StructField("output", T.StringType()), T.StructField(CORRUPT, T.StringType())]
)
ASSESSMENT_BODY = T.StructType(
    [
        T.StructField("step_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("ratings", T.StructType([*TEXT_RATINGS.fields, *RETRIEVAL_RATINGS.fields])),
        T.StructField(CORRUPT, T.StringType()),
    ]
)
PARSE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def payload_stream(
    spark: SparkSession, path: str, schema: T.StructType = PAYLOAD,
    max_files: int | None = None, glob: str | None = None,
) -> DataFrame:
    """Incremental read of a payload folder; no schema inference."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def parse_payloads(payloads: DataFrame) -> DataFrame:
    """Payload rows with their `outcome` and parsed bodies `req`, `res`, `ass`.

    The outcome is request, assessment or reject. The bodies go through
    `inline`, so each is parsed once, not once more for every field read.
    """
    is_request, is_assessment = F.col("kind") == REQUEST, F.col("kind") == ASSESSMENT
    bodies = F.struct(
        F.when(is_request, F.from_json("request", REQUEST_BODY, PARSE)).alias("req"),
        F.when(is_request, F.from_json("response", RESPONSE_BODY, PARSE)).alias("res"),
        F.when(is_assessment, F.from_json("request", ASSESSMENT_BODY, PARSE)).alias("ass"),
    )
    parsed = payloads.select("*", F.inline(F.array(bodies)))

    def readable(body: str) -> Column:
        return F.col(body).isNotNull() & F.col(body)[CORRUPT].isNull()

    outcome = (
        F.when(F.col("request_id").isNull(), F.lit(REJECT))
        .when(is_request & readable("req") & readable("res"), F.lit(REQUEST))
        .when(is_assessment & readable("ass"), F.lit(ASSESSMENT))
        .otherwise(F.lit(REJECT))
    )
    return parsed.withColumn("outcome", outcome)


def _ratings(half: T.StructType) -> Column:
    """The text or the retrieval half of a logged assessment's ratings."""
    return F.struct(F.struct(*[F.col(f"ass.ratings.{name}").alias(name) for name in half.names]).alias("ratings"))


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`(request log, assessment log, rejects)` from parsed payloads."""
    calls = parsed.filter((F.col("kind") == REQUEST) & (F.col("outcome") == REQUEST))
    requests = calls.select(
        F.struct("request_id", F.col("req.messages").alias("messages"), "ts").alias("request"),
        F.struct(F.col("req.app_version_id").alias("app_version_id"), "latency_ms").alias("trace"),
        F.col("res.output").alias("output"),
    )
    feedback = parsed.filter((F.col("kind") == ASSESSMENT) & (F.col("outcome") == ASSESSMENT))
    assessments = feedback.select(
        "request_id",
        F.col("ass.step_id").alias("step_id"),
        F.struct(F.col("ass.source").alias("type")).alias("source"),
        _ratings(TEXT_RATINGS).alias("text_assessment"),
        _ratings(RETRIEVAL_RATINGS).alias("retrieval_assessment"),
        "ts",
    )
    rejects = parsed.filter(F.col("outcome") == REJECT).drop("req", "res", "ass", "outcome")
    return requests, assessments, rejects


def unpack_payloads(payloads: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`(request log, assessment log, rejects)`; works on batches and streams.

    Rejects are payloads whose JSON cannot be read, whose kind is unknown, or
    that carry no request id. Every payload lands in exactly one of the three.
    """
    return split_parsed(parse_payloads(payloads))
