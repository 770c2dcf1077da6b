"""Ratings of answers and retrievals."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import _col, token_count, word_set
from ..schemas import RANK_CUTOFFS, RATING, rank_metric_name

# Fixed word list of the default harm rating; callers pass their own.
HARM_TERMS = (
    "clown",
    "disgusting",
    "idiot",
    "loser",
    "moron",
    "pathetic",
    "scum",
    "stupid",
    "trash",
    "worthless",
)


def latency_ms(start: Column | str, end: Column | str) -> Column:
    """Milliseconds between two time stamps."""
    return (F.unix_micros(_col(end)) - F.unix_micros(_col(start))) / F.lit(1000.0)


def output_tokens(text: Column | str) -> Column:
    return token_count(text).cast("double")


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(F.size(part).cast("double"), F.size(whole).cast("double"))


def lexical_faithful(answer: Column | str, context: Column | str) -> Column:
    """Share of the distinct answer words that occur in the context."""
    words = word_set(answer)
    return _share(F.array_intersect(words, word_set(context)), words)


def lexical_relevant(answer: Column | str, question: Column | str, context: Column | str) -> Column:
    """Share of the distinct answer words that occur in question or context."""
    words = word_set(answer)
    known = word_set(F.concat_ws(" ", _col(question), _col(context)))
    return _share(F.array_intersect(words, known), words)


def answer_f1(answer: Column | str, truth: Column | str) -> Column:
    """F1 of the distinct words of answer and ground truth; 0 without overlap."""
    ours, theirs = word_set(answer), word_set(truth)
    both = F.size(F.array_intersect(ours, theirs)).cast("double")
    return F.try_divide(2 * both, (F.size(ours) + F.size(theirs)).cast("double"))


def harm_share(text: Column | str, terms: Sequence[str] = HARM_TERMS) -> Column:
    """Share of the listed terms that occur among the words of the text."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(_col(text)), F.lit(r"[a-z]+"), F.lit(0)))
    listed = F.array(*[F.lit(t) for t in terms])
    return F.size(F.array_intersect(words, listed)) / F.lit(float(len(terms)))


def apply_judge(
    df: DataFrame,
    judge: Callable[[pd.DataFrame], pd.DataFrame],
    metric: str,
    columns: Sequence[str],
) -> DataFrame:
    """Add a rating struct from `judge`, which maps a frame of `columns` to
    `bool_value` and `double_value` for each row."""

    @F.pandas_udf(RATING)
    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield judge(frame)[["bool_value", "double_value"]].reset_index(drop=True)

    return df.withColumn(metric, rate(F.struct(*columns)))


def attach_truth(
    ranked: DataFrame, truth: DataFrame, query_id: str = "query_id", doc: str = "doc_uri"
) -> DataFrame:
    """Mark each retrieved row as relevant when (query, document) is in `truth`."""
    marks = truth.select(query_id, doc).distinct().withColumn("_hit", F.lit(1))
    joined = ranked.join(marks, [query_id, doc], "left")
    return joined.withColumn("relevant", F.coalesce("_hit", F.lit(0))).drop("_hit")


def truth_totals(truth: DataFrame, query_id: str = "query_id", doc: str = "doc_uri") -> DataFrame:
    """Number of relevant documents of each query."""
    return truth.select(query_id, doc).distinct().groupBy(query_id).agg(
        F.count(F.lit(1)).alias("n_relevant")
    )


def rank_metrics(
    ranked: DataFrame, totals: DataFrame, query_id: str = "query_id",
    rank: str = "rank", relevant: str = "relevant", cutoffs: Sequence[int] = RANK_CUTOFFS,
) -> DataFrame:
    """Precision, recall and NDCG at each cutoff, one row per query.

    `totals` has `n_relevant` per query. Gain is binary. Recall and NDCG of a
    query without relevant documents are null.
    """
    hit = F.col(relevant).cast("double")
    gain = hit / F.log2(F.col(rank) + 1.0)
    sums = []
    for k in cutoffs:
        inside = F.col(rank) <= k
        sums.append(F.sum(F.when(inside, hit).otherwise(0.0)).alias(f"_hits_{k}"))
        sums.append(F.sum(F.when(inside, gain).otherwise(0.0)).alias(f"_gain_{k}"))
    scored = ranked.groupBy(query_id).agg(*sums).join(totals, query_id, "left")
    total = F.when(F.col("n_relevant") > 0, F.col("n_relevant"))
    columns = [F.col(query_id)]
    for k in cutoffs:
        ideal = F.lit(0.0)
        for i in range(1, k + 1):
            ideal = ideal + F.when(total >= i, 1.0 / F.log2(F.lit(i + 1.0))).otherwise(0.0)
        values = {
            "precision": F.col(f"_hits_{k}") / F.lit(float(k)),
            "recall": F.col(f"_hits_{k}") / total,
            "ndcg": F.when(total.isNotNull(), F.col(f"_gain_{k}") / ideal),
        }
        columns += [v.alias(rank_metric_name(m, k)) for m, v in values.items()]
    return scored.select(*columns)


def rank_scores_of_lists(
    retrieved: Column | str, relevant: Column | str, cutoffs: Sequence[int] = RANK_CUTOFFS
) -> dict[str, Column]:
    """The same three metrics from a list of retrieved and a list of relevant
    documents in one row; needs no shuffle, so it also runs on a stream."""
    found, truth = _col(retrieved), F.array_distinct(_col(relevant))
    total = F.when(F.size(truth) > 0, F.size(truth))
    scores: dict[str, Column] = {}
    for k in cutoffs:
        hits = [
            F.when(F.array_contains(truth, F.try_element_at(found, F.lit(i))), 1.0).otherwise(0.0)
            for i in range(1, k + 1)
        ]
        n_hits, gain, ideal = F.lit(0.0), F.lit(0.0), F.lit(0.0)
        for i, hit in enumerate(hits, start=1):
            discount = F.log2(F.lit(i + 1.0))
            n_hits = n_hits + hit
            gain = gain + hit / discount
            ideal = ideal + F.when(total >= i, 1.0 / discount).otherwise(0.0)
        known = _col(retrieved).isNotNull() & total.isNotNull()
        scores[rank_metric_name("precision", k)] = F.when(
            _col(retrieved).isNotNull() & _col(relevant).isNotNull(), n_hits / F.lit(float(k))
        )
        scores[rank_metric_name("recall", k)] = F.when(known, n_hits / total)
        scores[rank_metric_name("ndcg", k)] = F.when(known, gain / ideal)
    return scores
