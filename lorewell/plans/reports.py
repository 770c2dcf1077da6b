"""Comparison of application versions over request and assessment logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..config import SAMPLE_REQUESTS, TOP_EXAMPLES
from ..functions.text import version_number
from ..operators import aggregates, reshape
from ..operators.joins import BROADCAST_BYTES, assessments_with_requests, measured_bytes
from ..operators.ranking import top_joined, top_per_group
from ..operators.versions import ALL_VERSIONS, distinct_versions, select_versions
from ..schemas import RANK_CUTOFFS, RANK_METRICS, rank_metric_name
from ..sources.scratch import freeze

Versions = Sequence[str] | None

# Positions of the box-plot numbers.
QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
QUARTILE_NAMES = ("score_min", "score_q1", "score_median", "score_q3", "score_max")

# The relevance report reads rows with a verdict only; the others also read
# rows that carry just a score.
VERDICT_ONLY = ("relevant_to_question_and_context",)


def _requests(requests: DataFrame, versions: Versions) -> DataFrame:
    return select_versions(requests, versions, "trace.app_version_id")


def trace_samples(
    requests: DataFrame, versions: Versions = None, n: int = SAMPLE_REQUESTS, order: Column | None = None
) -> DataFrame:
    """Traces of `n` requests side by side, one column per version.

    With all versions the list is read from the log first, since a pivot needs
    its columns; it is as short as the number of deployed versions.
    """
    if versions is None or ALL_VERSIONS in versions:
        versions = [r[0] for r in distinct_versions(requests).collect() if r[0] is not None]
    ids = (
        _requests(requests, versions)
        .select(F.col("request.request_id").alias("request_id"))
        .distinct()
        .orderBy("request_id")
        .limit(n)
    )
    flat = requests.select(
        F.col("request.request_id").alias("request_id"),
        F.col("trace.app_version_id").alias("app_version_id"),
        "request",
        "trace",
    ).filter(F.col("app_version_id").isin(list(versions)))
    picked = flat.join(F.broadcast(ids), "request_id", "left_semi")
    first = order if order is not None else F.to_json("trace")
    return reshape.pivot_versions(picked, ["request"], "app_version_id", versions, "trace", first)


def performance_log(requests: DataFrame, assessments: DataFrame, versions: Versions = None) -> DataFrame:
    """Joined rows with a latency or a token count."""
    return assessments_with_requests(_performance(assessments), _requests(requests, versions))


def _performance(assessments: DataFrame) -> DataFrame:
    latency = F.col("text_assessment.ratings.latency.double_value")
    token_count = F.col("text_assessment.ratings.token_count.double_value")
    return assessments.filter(latency.isNotNull() | token_count.isNotNull()).select(
        "request_id", "step_id", latency.alias("latency"), token_count.alias("token_count")
    )


def performance_by_version(
    requests: DataFrame, assessments: DataFrame, versions: Versions = None
) -> DataFrame:
    """Mean latency in milliseconds and mean output tokens by version number."""
    means = aggregates.means_over_join(
        _performance(assessments), _requests(requests, versions), ["latency", "token_count"]
    )
    return means.select(
        "rag_version", F.col("latency").alias("avg_latency"), F.col("token_count").alias("avg_token_count")
    )


def retrieval_log(requests: DataFrame, assessments: DataFrame, versions: Versions = None) -> DataFrame:
    """One row per joined assessment and cutoff, all-null rows left out."""
    ratings = assessments.select(
        "request_id",
        "step_id",
        F.col("source.type").alias("assessment_source"),
        F.col("retrieval_assessment.ratings").alias("ratings"),
    )
    joined = assessments_with_requests(ratings, _requests(requests, versions))
    keys = ["request_id", "step_id", "rag_version", "assessment_source"]
    return reshape.rank_scores_long(joined, keys).withColumn(
        "rag_version_number", version_number("rag_version")
    )


def retrieval_by_k_version(
    requests: DataFrame, assessments: DataFrame, versions: Versions = None
) -> DataFrame:
    """Mean recall, precision and NDCG by cutoff and version number.

    Averages all cutoffs in one pass over the wide rows, then turns the few
    result rows long.
    """
    names = [rank_metric_name(m, k) for k in RANK_CUTOFFS for m in RANK_METRICS]
    wide = assessments.select(
        "request_id",
        *[F.col(f"retrieval_assessment.ratings.{n}.double_value").alias(n) for n in names],
    ).filter(F.coalesce(*[F.col(n) for n in names]).isNotNull())
    means = aggregates.means_over_join(wide, _requests(requests, versions), names)
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("k"),
                *[F.col(rank_metric_name(m, k)).alias(f"avg_{m}") for m in RANK_METRICS],
            )
            for k in RANK_CUTOFFS
        ]
    )
    averages = [F.col(f"avg_{m}") for m in RANK_METRICS]
    return means.select("rag_version", F.inline(rows)).filter(F.coalesce(*averages).isNotNull())


def _rated(assessments: DataFrame, metric: str) -> DataFrame:
    rating = f"text_assessment.ratings.{metric}"
    verdict, score = F.col(f"{rating}.bool_value"), F.col(f"{rating}.double_value")
    present = verdict.isNotNull() if metric in VERDICT_ONLY else verdict.isNotNull() | score.isNotNull()
    return assessments.filter(present).select(
        "request_id",
        "step_id",
        F.col("source.type").alias("assessment_source"),
        verdict.cast("int").alias("value"),
        score.alias("score"),
    )


def generation_log(
    requests: DataFrame, assessments: DataFrame, metric: str, versions: Versions = None
) -> DataFrame:
    """Joined rows of one text metric, with the rated output."""
    columns = {"rag_version": F.col("trace.app_version_id"), "output_message": F.col("output")}
    return assessments_with_requests(
        _rated(assessments, metric), _requests(requests, versions), columns
    )


def share_by_version(
    requests: DataFrame, assessments: DataFrame, metric: str, versions: Versions = None
) -> DataFrame:
    """Share of true verdicts and mean score by version number."""
    means = aggregates.means_over_join(
        _rated(assessments, metric), _requests(requests, versions), ["value", "score"], "n_rows"
    )
    return means.select(
        "rag_version", F.col("value").alias("true_share"), F.col("score").alias("mean_score"), "n_rows"
    )


def score_distribution(
    requests: DataFrame, assessments: DataFrame, metric: str, versions: Versions = None,
    exact: bool = True,
) -> DataFrame:
    """Count, minimum, quartiles and maximum of the scores by version number."""
    rated = _rated(assessments, metric).select("request_id", "score").filter(F.col("score").isNotNull())
    if exact:
        counted = aggregates.values_over_join(rated, _requests(requests, versions), "score")
        return aggregates.exact_quantiles(counted, "rag_version", "score", QUARTILES, QUARTILE_NAMES)
    number = {"rag_version": version_number("trace.app_version_id")}
    joined = assessments_with_requests(rated, _requests(requests, versions), number)
    return aggregates.approximate_quantiles(joined, "rag_version", "score", QUARTILES, QUARTILE_NAMES)


def score_examples(
    requests: DataFrame, assessments: DataFrame, metric: str, versions: Versions = None,
    k: int = TOP_EXAMPLES, descending: bool = False,
) -> DataFrame:
    """The `k` rows per version with the lowest scores (`descending`: highest).

    Rows without a score come first in ascending order. Ties go by request id,
    step, source and output, so the result is always the same.
    """
    right = _requests(requests, versions).select(
        F.col("request.request_id").alias("request_id"),
        F.col("trace.app_version_id").alias("rag_version"),
        F.col("output").alias("output_message"),
    )
    score = F.col("score").desc_nulls_last() if descending else F.col("score").asc_nulls_first()
    n_groups = None if versions is None or ALL_VERSIONS in versions else len(versions)
    left_order = [score, F.col("step_id").asc(), F.col("assessment_source").asc(), F.col("value").asc()]
    return top_joined(
        _rated(assessments, metric), right, "request_id", "rag_version",
        left_order, [F.col("output_message").asc()], k, n_groups,
    )


def review_queue(
    review_requests: DataFrame, requests: DataFrame, assessments: DataFrame,
    per_version: int | None = None, order_by: str = "faithful_to_context",
) -> DataFrame:
    """Requests picked for review, with their latest verdicts, worst first.

    The verdict is the score with the newest time stamp, so the log may be raw
    or deduplicated. `per_version` limits the queue of each version. The picked
    requests are stored and measured; both logs are cut to them before anything
    is summed or made distinct.
    """
    metrics = ("harmful", "relevant_to_question_and_context", "faithful_to_context")
    columns, rated = [], F.lit(False)
    for m in metrics:
        score = F.col(f"text_assessment.ratings.{m}.double_value")
        rated = rated | score.isNotNull()
        when = F.when(score.isNotNull(), F.struct(F.col("ts"), F.col("step_id"), score))
        columns.append(F.max_by(score, when).alias(m))
    picked = freeze(review_requests.select("request_id", "app_version_id").distinct(), "picked")
    ids = picked.select("request_id").distinct()
    few = measured_bytes(picked) <= BROADCAST_BYTES
    scores = (
        assessments.filter(rated).join(F.broadcast(ids) if few else ids, "request_id", "left_semi")
        .groupBy("request_id").agg(*columns)
    )
    logged = requests.select(
        F.col("request.request_id").alias("request_id"),
        F.col("trace.app_version_id").alias("app_version_id"),
    ).join(F.broadcast(picked) if few else picked, ["request_id", "app_version_id"], "left_semi").distinct()
    queue = picked.join(logged, ["request_id", "app_version_id"]).join(scores, "request_id", "left")
    if per_version is None:
        return queue
    order = [F.col(order_by).asc_nulls_last(), F.col("request_id").asc()]
    return top_per_group(queue, ["app_version_id"], order, per_version, "place")
