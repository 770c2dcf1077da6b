"""Schemas of the tables that pass between operators."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT_METRICS = (
    "latency",
    "token_count",
    "harmful",
    "answer_correct",
    "faithful_to_context",
    "relevant_to_question_and_context",
)
RANK_CUTOFFS = (1, 3, 5)
RANK_METRICS = ("recall", "precision", "ndcg")

PAGE = T.StructType(
    [
        T.StructField("doc_uri", T.StringType()),
        T.StructField("html_content", T.StringType()),
    ]
)

EMBEDDED_CHUNK = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("doc_uri", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

MESSAGES = T.ArrayType(
    T.StructType(
        [
            T.StructField("role", T.StringType()),
            T.StructField("content", T.StringType()),
        ]
    )
)

RATING = T.StructType(
    [
        T.StructField("bool_value", T.BooleanType()),
        T.StructField("double_value", T.DoubleType()),
    ]
)


def rank_metric_name(metric: str, k: int) -> str:
    return f"retrieval_{metric}_at_{k}"


TEXT_RATINGS = T.StructType([T.StructField(m, RATING) for m in TEXT_METRICS])
RETRIEVAL_RATINGS = T.StructType(
    [
        T.StructField(rank_metric_name(m, k), RATING)
        for k in RANK_CUTOFFS
        for m in RANK_METRICS
    ]
)

REQUEST_LOG = T.StructType(
    [
        T.StructField(
            "request",
            T.StructType(
                [
                    T.StructField("request_id", T.StringType()),
                    T.StructField("messages", MESSAGES),
                    T.StructField("ts", T.TimestampType()),
                ]
            ),
        ),
        T.StructField(
            "trace",
            T.StructType(
                [
                    T.StructField("app_version_id", T.StringType()),
                    T.StructField("latency_ms", T.DoubleType()),
                ]
            ),
        ),
        T.StructField("output", T.StringType()),
    ]
)

ASSESSMENT_LOG = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("step_id", T.StringType()),
        T.StructField("source", T.StructType([T.StructField("type", T.StringType())])),
        T.StructField(
            "text_assessment", T.StructType([T.StructField("ratings", TEXT_RATINGS)])
        ),
        T.StructField(
            "retrieval_assessment",
            T.StructType([T.StructField("ratings", RETRIEVAL_RATINGS)]),
        ),
        T.StructField("ts", T.TimestampType()),
    ]
)

EVAL_DATASET = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("messages", MESSAGES),
        T.StructField(
            "ground_truth",
            T.StructType(
                [
                    T.StructField("answer", T.StringType()),
                    T.StructField("doc_uris", T.ArrayType(T.StringType())),
                ]
            ),
        ),
    ]
)

# One logged call of the hosted endpoint. `kind` tells a model call from a
# feedback call; the two JSON columns are unpacked by `streaming.payloads`.
PAYLOAD = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("request", T.StringType()),
        T.StructField("response", T.StringType()),
    ]
)
