import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lorewell.config import AnswerConfig, CorpusConfig
from lorewell.operators import messages as msg, metrics
from lorewell.operators.dedup import dedup_assessments
from lorewell.plans import answering, corpus, evaluation, reports
from lorewell.schemas import ASSESSMENT_LOG, EVAL_DATASET, REQUEST_LOG
from lorewell.sources.tables import write_embeddings

T0 = dt.datetime(2024, 1, 1, 10, 0)


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


def request(rid, version, output="out", ts=T0):
    return ((rid, [("user", "hi")], ts), (f"models:/app/{version}", 10.0), output)


def assessment(rid, step="s", ts=T0, source="human", text=None, ranks=None):
    text, ranks = text or {}, ranks or {}
    t = tuple(text.get(f) for f in ASSESSMENT_LOG["text_assessment"].dataType["ratings"].dataType.names)
    r = tuple(ranks.get(f) for f in ASSESSMENT_LOG["retrieval_assessment"].dataType["ratings"].dataType.names)
    return (rid, step, (source,), (t,), (r,), ts)


@pytest.fixture(scope="module")
def logs(spark):
    requests = spark.createDataFrame(
        [request("a", 1), request("b", 1, "bad"), request("c", 2), request("d", 2)], REQUEST_LOG
    )
    assessments = spark.createDataFrame(
        [
            assessment("a", text={"latency": (None, 10.0)}),
            assessment("a", text={"token_count": (None, 4.0)}),
            assessment("b", text={"latency": (None, 30.0)}),
            assessment("a", text={"harmful": (False, 0.1), "relevant_to_question_and_context": (None, 0.3)}),
            assessment("b", text={"harmful": (True, None)}),
            assessment("c", text={"harmful": (None, 0.7), "relevant_to_question_and_context": (True, 0.9)}),
            assessment("d", ranks={"retrieval_recall_at_1": (None, 0.5)}),
            assessment("zz", text={"harmful": (True, 1.0)}),
        ],
        ASSESSMENT_LOG,
    )
    return requests, assessments


def by(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_performance(logs):
    assert by(reports.performance_by_version(*logs, ["*"]), "rag_version", "avg_latency", "avg_token_count") == [
        ("1", 20.0, 4.0)
    ]
    assert reports.performance_by_version(*logs, ["models:/app/2"]).count() == 0
    assert reports.performance_log(*logs).count() == 3


def test_null_rules_of_the_logs(logs):
    harmful = reports.generation_log(*logs, "harmful")
    assert by(harmful, "request_id") == [("a",), ("b",), ("c",)]
    # The relevance log needs a verdict; the score of `a` alone is not enough.
    assert by(reports.generation_log(*logs, "relevant_to_question_and_context"), "request_id") == [("c",)]


def test_share_and_distribution(logs):
    share = reports.share_by_version(*logs, "harmful")
    assert by(share, "rag_version", "true_share", "mean_score", "n_rows") == [("1", 0.5, 0.1, 2), ("2", None, 0.7, 1)]
    spread = reports.score_distribution(*logs, "harmful")
    assert by(spread, "rag_version", "n_scores", "score_median") == [("1", 1, 0.1), ("2", 1, 0.7)]
    rough = reports.score_distribution(*logs, "harmful", exact=False)
    assert by(rough, "rag_version", "score_max") == [("1", 0.1), ("2", 0.7)]


def test_examples_put_missing_scores_first(logs):
    top = reports.score_examples(*logs, "harmful", k=1)
    assert by(top, "rag_version", "request_id") == [("models:/app/1", "b"), ("models:/app/2", "c")]
    worst = reports.score_examples(*logs, "harmful", ["models:/app/1"], k=1, descending=True)
    assert by(worst, "request_id", "output_message") == [("a", "out")]


def test_retrieval_reports(logs):
    assert by(reports.retrieval_log(*logs), "request_id", "k", "rag_version_number") == [("d", 1, "2")]
    got = reports.retrieval_by_k_version(*logs)
    assert by(got, "rag_version", "k", "avg_recall", "avg_precision") == [("2", 1, 0.5, None)]


def test_trace_samples(logs):
    wide = reports.trace_samples(logs[0], ["*"], n=3)
    assert wide.count() == 3
    assert wide.columns == ["request", "models:/app/1", "models:/app/2"]


def test_filters_reach_the_scan(spark, logs, tmp_path):
    for df, name in zip(logs, ("requests", "assessments")):
        df.write.parquet(str(tmp_path / name))
    requests = spark.read.parquet(str(tmp_path / "requests"))
    assessments = spark.read.parquet(str(tmp_path / "assessments"))
    report = reports.share_by_version(requests, assessments, "relevant_to_question_and_context", ["models:/app/1"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "In(trace.app_version_id" in plan or "EqualTo(trace.app_version_id" in plan
    assert "IsNotNull(text_assessment.ratings.relevant_to_question_and_context.bool_value)" in plan
    read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert len(read) == 2 and not any("output:" in r or "faithful" in r for r in read)


def test_hourly_dedup(spark):
    rows = [
        assessment("a", ts=minutes(5), text={"harmful": (True, 0.1)}),
        assessment("a", ts=minutes(50), text={"harmful": (True, 0.2)}),
        assessment("a", ts=minutes(50), text={"latency": (None, 5.0)}),
        assessment("a", ts=minutes(61), text={"harmful": (True, 0.3)}),
        assessment("a", ts=minutes(51), source="auto", text={"harmful": (True, 0.4)}),
    ]
    kept = dedup_assessments(spark.createDataFrame(rows, ASSESSMENT_LOG))
    scores = by(kept.select(F.coalesce("text_assessment.ratings.harmful.double_value", F.lit(9.0)).alias("s")), "s")
    assert scores == [(0.2,), (0.3,), (0.4,), (9.0,)]
    assert dedup_assessments(kept).count() == 4
    assert dedup_assessments(kept, "day").count() == 3


def test_review_queue(spark, logs):
    requests, _ = logs
    ratings = [
        assessment("a", ts=minutes(1), text={"faithful_to_context": (True, 0.9)}),
        assessment("a", ts=minutes(90), text={"faithful_to_context": (True, 0.2)}),
        assessment("b", text={"faithful_to_context": (True, 0.5)}),
    ]
    wanted = spark.createDataFrame(
        [("a", "models:/app/1"), ("b", "models:/app/1"), ("c", "models:/app/1"), ("d", "models:/app/2")],
        "request_id string, app_version_id string",
    )
    queue = reports.review_queue(wanted, requests, spark.createDataFrame(ratings, ASSESSMENT_LOG), per_version=2)
    assert by(queue, "app_version_id", "place", "request_id") == [
        ("models:/app/1", 1, "a"), ("models:/app/1", 2, "b"), ("models:/app/2", 1, "d"),
    ]


def test_rank_metrics(spark):
    ranked = spark.createDataFrame(
        [("q", f"d{i}", i) for i in range(1, 6)] + [("none", "d1", 1)], "query_id string, doc_uri string, rank int"
    )
    truth = spark.createDataFrame([("q", "d1"), ("q", "d3"), ("q", "d9"), ("q", "d9")], "query_id string, doc_uri string")
    marked = metrics.attach_truth(ranked, truth)
    got = {r.query_id: r for r in metrics.rank_metrics(marked, metrics.truth_totals(truth)).collect()}
    q = got["q"]
    assert (q.retrieval_precision_at_1, q.retrieval_precision_at_5) == (1.0, 0.4)
    assert q.retrieval_recall_at_3 == pytest.approx(2 / 3)
    assert q.retrieval_ndcg_at_3 == pytest.approx((1 + 0.5) / (1 + 0.6309297535714575 + 0.5))
    assert got["none"].retrieval_recall_at_1 is None and got["none"].retrieval_ndcg_at_5 is None
    assert got["none"].retrieval_precision_at_1 == 0.0
    lists = spark.createDataFrame([([f"d{i}" for i in range(1, 6)], ["d1", "d3", "d9"])], "f array<string>, t array<string>")
    row = lists.select([c.alias(n) for n, c in metrics.rank_scores_of_lists("f", "t").items()]).first()
    assert all(row[n] == pytest.approx(q[n]) for n in row.asDict())


def test_lexical_scores(spark):
    df = spark.createDataFrame([("A b c", "b", "a x"), ("", "q", "c")], "answer string, question string, context string")
    rows = df.select(
        metrics.lexical_faithful("answer", "context").alias("f"),
        metrics.lexical_relevant("answer", "question", "context").alias("r"),
        metrics.answer_f1("answer", "context").alias("f1"),
        metrics.harm_share(F.lit("You IDIOT, you scum!")).alias("h"),
    ).collect()
    assert rows[0].f == pytest.approx(1 / 3) and rows[0].r == pytest.approx(2 / 3)
    assert rows[0].f1 == pytest.approx(2 / 5) and rows[0].h == pytest.approx(0.2)
    assert rows[1].f is None and rows[1].f1 == 0.0


def test_run_eval_with_a_judge(spark, logs):
    def judge(frame: pd.DataFrame) -> pd.DataFrame:
        bad = frame["output"].str.contains("bad")
        return pd.DataFrame({"bool_value": bad, "double_value": bad.astype(float)})

    rated = evaluation.run_eval(logs[0], judges={"harmful": (judge, ["output"])})
    assert [f.name for f in rated.schema] == [f.name for f in ASSESSMENT_LOG]
    verdicts = rated.select("request_id", F.col("text_assessment.ratings.harmful.bool_value").alias("v"))
    assert by(verdicts, "request_id", "v") == [("a", False), ("b", True), ("c", False), ("d", False)]
    long = evaluation.ratings_long(rated)
    assert {r.metric for r in long.collect()} == {"latency", "token_count", "harmful"}
    with pytest.raises(ValueError):
        evaluation.run_eval(logs[0], judges={"other": (judge, ["output"])})


def test_messages_from_rows(spark):
    rows = spark.createDataFrame(
        [(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "z")],
        "conv_id int, turn int, role string, text string",
    ).repartition(3)
    chats = {r.conv_id: r.messages for r in msg.assemble_messages(rows).collect()}
    assert [(m.role, m.content) for m in chats[1]] == [("user", "a"), ("assistant", "b"), ("user", "c")]
    assert by(msg.questions(rows), "conv_id", "question") == [(1, "c"), (2, "z")]
    assert by(msg.history_rows(rows), "conv_id", "turn") == [(1, 0), (1, 1)]
    assert by(msg.retrieval_queries(rows, 1), "conv_id", "query") == [(1, "b c"), (2, "z")]


@pytest.fixture(scope="module")
def chunks(spark, tmp_path_factory):
    docs = spark.createDataFrame(
        [(f"doc/{i}", f"{topic} " * 4 + "shared words") for i, topic in enumerate(("spark", "flink", "duck", "arrow"))],
        "doc_uri string, content string",
    )
    path = str(tmp_path_factory.mktemp("corpus") / "v1")
    config = CorpusConfig(min_chunk_size=1)
    write_embeddings(corpus.build_text_corpus(docs, config), path)
    return spark.read.parquet(path)


def dataset(spark):
    return spark.createDataFrame(
        [
            ("r1", [("user", "hello"), ("assistant", "yes"), ("user", "spark spark")], ("spark shared", ["doc/0"])),
            ("r2", [("user", "duck {context}")], ("duck", ["doc/2", "doc/9"])),
            ("r3", [], (None, None)),
        ],
        EVAL_DATASET,
    )


@pytest.mark.parametrize("use_mmr", [False, True])
def test_answers(spark, chunks, use_mmr):
    config = AnswerConfig(k=2, use_mmr=use_mmr, history_turns=0, query_instruction="")
    got = {r.request_id: r for r in answering.answer_batch(dataset(spark), chunks, config).collect()}
    assert set(got) == {"r1", "r2", "r3"}
    assert got["r1"].output.startswith("spark") and len(got["r1"].doc_uris) == 2
    assert "user: hello\nassistant: yes" in got["r1"].prompt and "spark spark" in got["r1"].prompt
    assert "duck {context}" in got["r2"].prompt
    assert got["r3"].output is None and got["r3"].context is None


def test_answer_hooks(spark, chunks):
    def rewriter():
        return lambda texts: ["arrow" for _ in texts]

    def model():
        return lambda prompts: [f"{len(p)} chars" for p in prompts]

    config = AnswerConfig(k=1, query_instruction="")
    rows = answering.answer_batch(dataset(spark), chunks, config, make_model=model, make_rewriter=rewriter).collect()
    assert all(r.doc_uris == ["doc/3"] for r in rows)
    assert all(r.output == f"{len(r.prompt)} chars" for r in rows)


def test_offline_evaluation(spark, chunks, tmp_path, monkeypatch):
    config = AnswerConfig(k=2, history_turns=0, query_instruction="")
    names = [str(tmp_path / n) for n in ("requests", "assessments", "state")]

    def run(version, uri="models:/app/4"):
        return evaluation.run_offline_eval(dataset(spark), version, chunks, uri, *names, "exp", config)

    assert run(1) == "overwrite"
    log = spark.read.parquet(names[1])
    rated = {r.request_id: r for r in log.collect()}
    assert rated["r1"].retrieval_assessment.ratings.retrieval_recall_at_3.double_value == 1.0
    assert rated["r2"].retrieval_assessment.ratings.retrieval_recall_at_1.double_value == 0.5
    assert rated["r3"].retrieval_assessment.ratings.retrieval_recall_at_1.double_value is None
    assert rated["r2"].text_assessment.ratings.faithful_to_context.double_value == 1.0
    assert run(1) == "append"
    assert spark.read.parquet(names[1]).count() == 3
    assert run(1, "models:/app/5") == "append"
    assert spark.read.parquet(names[1]).count() == 6
    real = evaluation.run_eval
    monkeypatch.setattr(evaluation, "run_eval", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(2)
    monkeypatch.setattr(evaluation, "run_eval", real)
    assert run(2) == "overwrite"
    assert spark.read.parquet(names[1]).count() == 3


def test_harm_model_scores_from_stored_weights(spark):
    from lorewell.operators import harm_model

    rows = [(i, ("you are a vile idiot " if i % 3 == 0 else "the weather is mild today ") + f"w{i}", int(i % 3 == 0)) for i in range(60)]
    rows += [(100, None, 0), (101, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = harm_model.fit(df)
    mine = {r.doc_id: r.harm_score for r in harm_model.score(model, df).collect()}
    own = model.pipeline.transform(df.withColumn("_text", F.coalesce("text", F.lit(""))))
    theirs = {r.doc_id: float(r._prob[1]) for r in own.collect()}
    assert all(abs(mine[d] - theirs[d]) < 1e-9 for d in theirs)
    assert mine[100] == mine[101]
    test = df.filter(harm_model.held_out())
    assert harm_model.auc(harm_model.score(model, test), "harm_score") > 0.9
