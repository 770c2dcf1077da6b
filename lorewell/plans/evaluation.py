"""Predictions over an evaluation dataset, and ratings of a request log."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..config import AnswerConfig
from ..functions import chat
from ..operators import metrics
from ..schemas import (
    ASSESSMENT_LOG,
    RANK_CUTOFFS,
    RANK_METRICS,
    RATING,
    TEXT_METRICS,
    rank_metric_name,
)
from ..sources.scratch import freeze
from ..sources.tables import WriteModes, read_table, write_run
from .answering import answer_batch

Judge = Callable[[pd.DataFrame], pd.DataFrame]
HARM_THRESHOLD = 0.0
AGREEMENT_THRESHOLD = 0.5


def rating(verdict: Column | None = None, score: Column | None = None) -> Column:
    return F.struct(
        (F.lit(None).cast("boolean") if verdict is None else verdict).alias("bool_value"),
        (F.lit(None) if score is None else score).cast("double").alias("double_value"),
    )


def text_assessment(ratings: dict[str, Column]) -> Column:
    """The text half of an assessment; metrics not given are null."""
    if not ratings:
        return F.lit(None).cast(ASSESSMENT_LOG["text_assessment"].dataType)
    missing = F.lit(None).cast(RATING)
    return F.struct(F.struct(*[ratings.get(m, missing).alias(m) for m in TEXT_METRICS]).alias("ratings"))


def retrieval_assessment(scores: dict[str, Column]) -> Column:
    """The retrieval half, from scores by metric name; null without any."""
    if not scores:
        return F.lit(None).cast(ASSESSMENT_LOG["retrieval_assessment"].dataType)
    missing = F.lit(None).cast(RATING)
    names = [rank_metric_name(m, k) for k in RANK_CUTOFFS for m in RANK_METRICS]
    entries = [(rating(score=scores[n]) if n in scores else missing).alias(n) for n in names]
    return F.struct(F.struct(*entries).alias("ratings"))


def offline_predictions(
    dataset: DataFrame, corpus: DataFrame, version_uri: str,
    config: AnswerConfig = AnswerConfig(), **models,
) -> DataFrame:
    """Request log of one version over a whole evaluation dataset.

    Adds the retrieved documents and the ground truth, which `run_eval` reads.
    """
    answers = answer_batch(dataset.select("request_id", "messages", "ground_truth"), corpus, config, **models)
    return answers.select(
        F.struct(
            "request_id", "messages", F.lit(None).cast("timestamp").alias("ts")
        ).alias("request"),
        F.struct(
            F.lit(version_uri).alias("app_version_id"), F.lit(None).cast("double").alias("latency_ms")
        ).alias("trace"),
        "output",
        F.col("doc_uris").alias("retrieved"),
        "context",
        "ground_truth",
    )


def text_ratings(
    with_ground_truth: bool, has_context: bool, harm_terms: Sequence[str] = metrics.HARM_TERMS
) -> dict[str, Column]:
    """Default ratings of a request row, by metric; clearly lexical, not judged."""
    harm = metrics.harm_share("output", harm_terms)
    ratings = {
        "latency": rating(score=F.col("trace.latency_ms")),
        "token_count": rating(score=metrics.output_tokens("output")),
        "harmful": rating(harm > HARM_THRESHOLD, harm),
    }
    if has_context:
        question = chat.question("request.messages")
        faithful = metrics.lexical_faithful("output", "context")
        relevant = metrics.lexical_relevant("output", question, F.col("context"))
        ratings["faithful_to_context"] = rating(faithful >= AGREEMENT_THRESHOLD, faithful)
        ratings["relevant_to_question_and_context"] = rating(relevant >= AGREEMENT_THRESHOLD, relevant)
    if with_ground_truth:
        f1 = metrics.answer_f1("output", "ground_truth.answer")
        ratings["answer_correct"] = rating(f1 >= AGREEMENT_THRESHOLD, f1)
    return ratings


def run_eval(
    request_log: DataFrame,
    with_ground_truth: bool = False,
    judges: dict[str, tuple[Judge, Sequence[str]]] | None = None,
    harm_terms: Sequence[str] = metrics.HARM_TERMS,
    step_id: str = "eval",
    source: str = "automatic",
) -> DataFrame:
    """One assessment row per request, stateless, so it also runs on a stream.

    `judges` replaces metrics by `(function, input columns)`. Metrics whose
    inputs are missing are null.
    """
    rows = request_log
    ratings = text_ratings(with_ground_truth, "context" in rows.columns, harm_terms)
    for metric, (judge, columns) in (judges or {}).items():
        if metric not in TEXT_METRICS:
            raise ValueError(f"unknown metric {metric}")
        rows = metrics.apply_judge(rows, judge, f"_judge_{metric}", columns)
        ratings[metric] = F.col(f"_judge_{metric}")
    ranks: dict[str, Column] = {}
    if with_ground_truth:
        ranks = metrics.rank_scores_of_lists("retrieved", "ground_truth.doc_uris")
    return rows.select(
        F.col("request.request_id").alias("request_id"),
        F.lit(step_id).alias("step_id"),
        F.struct(F.lit(source).alias("type")).alias("source"),
        text_assessment(ratings).alias("text_assessment"),
        retrieval_assessment(ranks).alias("retrieval_assessment"),
        F.col("request.ts").alias("ts"),
    )


def ratings_long(assessments: DataFrame) -> DataFrame:
    """One row per request, step and text metric that has a rating."""
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"text_assessment.ratings.{m}.bool_value").alias("bool_value"),
                F.col(f"text_assessment.ratings.{m}.double_value").alias("double_value"),
            )
            for m in TEXT_METRICS
        ]
    )
    long = assessments.select("request_id", "step_id", F.inline(rows))
    return long.filter(F.col("bool_value").isNotNull() | F.col("double_value").isNotNull())


def run_offline_eval(
    dataset: DataFrame, dataset_version: int, corpus: DataFrame, version_uri: str,
    request_table: str, assessment_table: str, state_root: str, experiment: str,
    config: AnswerConfig = AnswerConfig(), **models,
) -> str:
    """Predict, rate and write both logs; returns the write mode used.

    The request log is written first and read back for the ratings, so the
    predictions are computed once. The dataset version is recorded only after
    both logs are written: a run that failed is repeated in the same mode, and
    its rows replace those of the failed attempt.
    """
    session = dataset.sparkSession
    modes = WriteModes(session, state_root)
    mode = modes.peek(experiment, dataset_version)
    write_run(offline_predictions(dataset, corpus, version_uri, config, **models), request_table, version_uri, mode)
    written = read_table(session, request_table).filter(F.col("run") == version_uri).drop("run")
    write_run(run_eval(written, with_ground_truth=True), assessment_table, version_uri, mode)
    modes.commit(experiment, dataset_version)
    return mode
