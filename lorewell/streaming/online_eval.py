"""Online evaluation: unpack, rate, persist, deduplicate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import dedup_assessments, latest_per_period
from ..plans.evaluation import run_eval
from ..schemas import ASSESSMENT_LOG, REQUEST_LOG
from ..sources.tables import VersionedPartitions
from .payloads import parse_payloads, split_parsed, unpack_payloads


def _trigger(every: str | None) -> dict:
    return {"availableNow": True} if every is None else {"processingTime": every}


def persist_stream(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append everything new to a Parquet folder and stop; a rerun adds nothing.

    With `every`, such as "5 minutes", the query goes on; a run that takes
    longer than that delays the next one, so runs never overlap.
    """
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**_trigger(every))
        .start()
    )


def online_streams(payloads: DataFrame, **evaluation) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Streaming request log, all assessments (logged and computed), rejects."""
    requests, logged, rejects = unpack_payloads(payloads)
    computed = run_eval(requests, **evaluation)
    return requests, logged.unionByName(computed), rejects


def persist_online(
    payloads: DataFrame, request_path: str, assessment_path: str, reject_path: str, checkpoint: str,
    run_eval_with: dict | None = None, every: str | None = None,
) -> StreamingQuery:
    """One query that reads the payloads once and writes all three logs.

    Each micro-batch writes its own `batch=<id>` folder with overwrite, so a
    batch that is repeated after a failure replaces itself.
    """
    evaluation = run_eval_with or {}

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_payloads(batch).persist()
        try:
            requests, logged, rejects = split_parsed(parsed)
            assessments = logged.unionByName(run_eval(requests, **evaluation))
            for df, path in (
                (requests, request_path), (assessments, assessment_path), (rejects, reject_path)
            ):
                df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            parsed.unpersist()

    return (
        payloads.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def read_log(spark: SparkSession, path: str, schema) -> DataFrame:
    """A log written by `persist_online`, without its batch column."""
    return spark.read.schema(schema).parquet(path).select(*[f.name for f in schema.fields])


def deduplicated_log(spark: SparkSession, root: str) -> VersionedPartitions:
    """The published assessment log, partitioned by deduplication period."""
    return VersionedPartitions(spark, root, "period", ASSESSMENT_LOG)


# Labels of the periods a log can be published by.
PERIOD_LABELS = {"minute": "yyyy-MM-dd-HH-mm", "hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd"}


def publish_deduplicated(
    spark: SparkSession, assessment_path: str, root: str, granularity: str = "hour"
) -> int:
    """Bring the published log up to date; returns the number of periods rewritten.

    Equals deduplicating the whole log, but reads and rewrites only periods with
    new rows: the latest of old and new is the latest of the old winner and the
    new. A log is published by one granularity.
    """
    if granularity not in PERIOD_LABELS:
        raise ValueError(f"cannot publish by {granularity}")
    store = deduplicated_log(spark, root)
    batched = ASSESSMENT_LOG.fields + [T.StructField("batch", T.LongType())]
    log = spark.read.schema(T.StructType(batched)).parquet(assessment_path)
    done = store.mark()
    new = log if done is None else log.filter(F.col("batch") > done)
    period = F.coalesce(F.date_format("ts", PERIOD_LABELS[granularity]), F.lit("unknown"))
    found = new.groupBy(period.alias("period")).agg(F.max("batch").alias("last")).collect()
    if not found:
        return 0
    old = store.read([r["period"] for r in found])
    merged = dedup_assessments(old.unionByName(new.drop("batch")), granularity)
    store.replace(merged.withColumn("period", period), max(r["last"] for r in found))
    return len(found)


def run_online_eval(
    spark: SparkSession, payloads: DataFrame, root: str, run_eval_with: dict | None = None
) -> tuple[DataFrame, DataFrame]:
    """One bounded run over everything new below `root`; returns both logs.

    Call it from a timer; runs must not overlap.
    """
    requests, assessments = f"{root}/requests", f"{root}/assessments"
    query = persist_online(
        payloads, requests, assessments, f"{root}/rejects", f"{root}/checkpoint", run_eval_with
    )
    run_bounded(query)
    publish_deduplicated(spark, assessments, f"{root}/deduplicated")
    return (
        read_log(spark, requests, REQUEST_LOG),
        deduplicated_log(spark, f"{root}/deduplicated").read(),
    )


def stream_latest_per_hour(
    rows: DataFrame, keys: Sequence[str], ts: str, tie_break: str, watermark: str = "1 hour",
    period: str = "1 hour",
) -> DataFrame:
    """Streaming form: the latest row of each key and hour, sent when the hour closes.

    State holds one row per key and open hour. Rows later than the watermark
    are left to the batch form.
    """
    others = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*others), F.struct(F.col(ts), F.col(tie_break)))
    grouped = (
        rows.withWatermark(ts, watermark)
        .groupBy(*keys, F.window(ts, period).alias("_w"))
        .agg(newest.alias("_row"))
    )
    return grouped.select(*keys, F.col("_w.start").alias("hour"), "_row.*")


def persist_latest(
    rows: DataFrame, path: str, checkpoint: str, keys: Sequence[str], ts: str, tie_break: str,
    period: str = "hour", every: str | None = None,
) -> StreamingQuery:
    """Write the latest row of each key and period of every micro-batch.

    `read_latest` merges them. No state is kept and no row is too late: the
    latest of all rows is the latest of the micro-batches' latest.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        latest = latest_per_period(batch, keys, ts, [tie_break], period, period)
        latest.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def read_latest(
    spark: SparkSession, path: str, keys: Sequence[str], ts: str, tie_break: str, period: str = "hour"
) -> DataFrame:
    """The latest row of each key and period over everything `persist_latest` wrote."""
    return latest_per_period(spark.read.parquet(path).drop("batch", period), keys, ts, [tie_break], period, period)


def run_bounded(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for an available-now query and raise its error, if any."""
    query.awaitTermination(timeout)
    if query.exception():
        raise query.exception()

