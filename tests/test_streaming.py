import datetime as dt
import json


from lorewell.operators.dedup import dedup_assessments
from lorewell.plans.evaluation import ratings_long, run_eval
from lorewell.schemas import ASSESSMENT_LOG, PAYLOAD, REQUEST_LOG
from lorewell.streaming import online_eval as online
from lorewell.streaming.payloads import payload_stream, unpack_payloads

T0 = dt.datetime(2024, 1, 1, 10, 0)


def call(rid, kind="request", minute=0, request=None, response='{"output": "an answer"}'):
    if request is None:
        request = json.dumps({"app_version_id": "m/1", "messages": [{"role": "user", "content": "q"}]})
    return (rid, kind, T0 + dt.timedelta(minutes=minute), 200, 12.5, request, response)


def feedback(rid, score, minute):
    body = {"step_id": "f", "source": "human", "ratings": {"harmful": {"bool_value": False, "double_value": score}}}
    return call(rid, "assessment", minute, json.dumps(body), None)


def batch_one():
    return [
        call("a"), call("b", minute=3), feedback("a", 0.1, 5), feedback("a", 0.2, 40),
        call("c", request="{broken"), call("d", response="not json"), call("e", kind="other"), call(None),
        feedback("x", 0.5, 1)[:5] + ("[]", None),
    ]


def write(spark, rows, folder):
    spark.createDataFrame(rows, PAYLOAD).coalesce(1).write.mode("append").parquet(folder)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_every_payload_lands_in_one_place(spark):
    df = spark.createDataFrame(batch_one(), PAYLOAD)
    requests, assessments, rejects = unpack_payloads(df)
    assert requests.schema.simpleString() == REQUEST_LOG.simpleString()
    assert assessments.schema.simpleString() == ASSESSMENT_LOG.simpleString()
    assert tuples(requests.select("request.request_id", "trace.app_version_id", "output")) == [
        ("a", "m/1", "an answer"), ("b", "m/1", "an answer"),
    ]
    n = requests.count() + assessments.count() + rejects.count()
    assert n == len(batch_one())
    assert {r.request_id for r in rejects.collect()} >= {"c", "d", "e", None}


def test_logged_retrieval_ratings_are_kept(spark):
    ratings = {"harmful": {"bool_value": True}, "retrieval_recall_at_3": {"double_value": 0.5}}
    body = json.dumps({"step_id": "f", "source": "human", "ratings": ratings})
    _, assessments, _ = unpack_payloads(spark.createDataFrame([call("a", "assessment", 0, body, None)], PAYLOAD))
    row = assessments.first()
    assert row.text_assessment.ratings.harmful.bool_value is True
    assert row.retrieval_assessment.ratings.retrieval_recall_at_3.double_value == 0.5
    assert row.retrieval_assessment.ratings.retrieval_recall_at_1 is None


def test_streams_equal_batches_and_reruns_add_nothing(spark, tmp_path):
    folder = str(tmp_path / "in")
    write(spark, batch_one(), folder)
    stream = payload_stream(spark, folder, max_files=1)
    requests, assessments, rejects = online.online_streams(stream)
    batch = online.online_streams(spark.read.parquet(folder))
    for name, df, twin in zip(("r", "a", "x"), (requests, assessments, rejects), batch):
        out, checkpoint = str(tmp_path / name), str(tmp_path / f"ck-{name}")
        for _ in range(2):
            online.run_bounded(online.persist_stream(df, out, checkpoint))
        assert tuples(spark.read.schema(df.schema).parquet(out)) == tuples(twin)


def test_online_run(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, batch_one(), folder)

    def run():
        requests, assessments = online.run_online_eval(spark, payload_stream(spark, folder, max_files=1), root)
        return requests, assessments

    requests, assessments = run()
    assert requests.count() == 2
    harm = assessments.filter("step_id = 'f'").select("text_assessment.ratings.harmful.double_value")
    assert tuples(harm) == [(0.2,)]
    before = tuples(ratings_long(assessments))
    requests, assessments = run()
    assert requests.count() == 2 and tuples(ratings_long(assessments)) == before

    write(spark, [call("g", minute=90), feedback("a", 0.3, 55), feedback("a", 0.4, 70)], folder)
    requests, assessments = run()
    assert requests.count() == 3
    harm = assessments.filter("step_id = 'f'").select("text_assessment.ratings.harmful.double_value")
    assert tuples(harm) == [(0.3,), (0.4,)]

    everything = spark.read.parquet(folder)
    logged, rejects = unpack_payloads(everything)[1:]
    twin = dedup_assessments(logged.unionByName(run_eval(unpack_payloads(everything)[0])))
    assert tuples(ratings_long(assessments)) == tuples(ratings_long(twin))
    assert spark.read.schema(PAYLOAD).parquet(f"{root}/rejects").count() == rejects.count()


def test_repeated_micro_batch_replaces_itself(spark, tmp_path):
    folder = str(tmp_path / "in")
    write(spark, batch_one(), folder)
    paths = [str(tmp_path / n) for n in ("r", "a", "x")]
    for attempt in range(2):
        # A lost checkpoint makes the same batch run again under the same number.
        query = online.persist_online(payload_stream(spark, folder), *paths, str(tmp_path / f"ck{attempt}"))
        online.run_bounded(query)
    assert online.read_log(spark, paths[0], REQUEST_LOG).count() == 2


def test_stream_latest_per_hour_matches_batch_for_closed_hours(spark, tmp_path):
    schema = "id long, key string, ts timestamp, v double"
    rows = [(i, f"k{i % 3}", T0 + dt.timedelta(minutes=7 * i), float(i)) for i in range(60)]
    folder = str(tmp_path / "in")
    for part in range(3):
        spark.createDataFrame(rows[part * 20 : part * 20 + 20], schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    latest = online.stream_latest_per_hour(stream, ["key"], "ts", "id")
    out = str(tmp_path / "out")
    online.run_bounded(online.persist_stream(latest, out, str(tmp_path / "ck")))
    got = spark.read.schema(latest.schema).parquet(out)
    want = {}
    for i, key, ts, _ in rows:
        hour = ts.replace(minute=0)
        want[key, hour] = max(i, want.get((key, hour), -1))
    found = {(r.key, r.hour): r.id for r in got.collect()}
    assert found and all(want[k] == v for k, v in found.items())
    newest = max(r[2] for r in rows)
    closed = {k for k in want if k[1] + dt.timedelta(hours=2) <= newest}
    assert closed <= set(found)


def test_payload_filter_by_name(spark, tmp_path):
    folder = str(tmp_path / "in")
    write(spark, batch_one(), folder)
    stream = payload_stream(spark, folder, glob="nothing*.parquet")
    online.run_bounded(online.persist_stream(stream, str(tmp_path / "o"), str(tmp_path / "c")))
    assert stream.isStreaming


def test_periodic_trigger(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, batch_one(), folder)
    query = online.persist_stream(payload_stream(spark, folder), out, str(tmp_path / "ck"), every="1 second")
    try:
        query.processAllAvailable()
        write(spark, [call("late", minute=5)], folder)
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.schema(PAYLOAD).parquet(out).count() == len(batch_one()) + 1


def test_publish_touches_only_hours_with_new_rows(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path / "pub")

    def add(batch, rows):
        _, assessments, _ = unpack_payloads(spark.createDataFrame(rows, PAYLOAD))
        assessments.write.parquet(f"{log}/batch={batch}")

    day = 24 * 60
    add(0, [feedback("a", 0.1, 0), feedback("a", 0.2, day), feedback("b", 0.3, day)])
    assert online.publish_deduplicated(spark, log, root) == 2
    add(1, [feedback("a", 0.4, day + 10), feedback("c", 0.5, day + 70)])
    assert online.publish_deduplicated(spark, log, root) == 2
    assert online.publish_deduplicated(spark, log, root) == 0
    store = online.deduplicated_log(spark, root)
    versions = {r["part"]: r["version"] for r in store._pointers().orderBy("version").collect()}
    assert versions == {"2024-01-01-10": 1, "2024-01-02-10": 2, "2024-01-02-11": 2}
    assert tuples(store.read()) == tuples(dedup_assessments(online.read_log(spark, log, ASSESSMENT_LOG)))
    assert store.read(["2024-01-01-10"]).count() == 1


def test_a_large_event_table_gives_three_batches_of_many_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from checks import fixtures as fx

    events = spark.range(4000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id % 7 AS user_id", "'view' AS event_type",
        "CAST(id AS DOUBLE) AS value", "'{}' AS props",
    )
    events.repartition(6).write.parquet(str(tmp_path / "events.parquet"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        stream = fx.event_stream(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    counts = []
    query = stream.writeStream.foreachBatch(lambda df, i: counts.append((df.select(F.input_file_name()).distinct().count(), df.count())))
    query.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    assert len(counts) == 3 and sum(n for _, n in counts) == 4000
    assert min(files for files, _ in counts) >= 6  # one file, so one task, before
