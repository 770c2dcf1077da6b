"""Batches of conversations to prompts and answers over a chunk table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..config import AnswerConfig
from ..functions import chat
from ..functions.text import fill_template
from ..operators.embed import Embedder, embed_text
from ..operators.joins import lookup_join, salted_join
from ..operators.knn import nearest
from ..operators.mmr import mmr_rerank
from ..sources.scratch import freeze, freeze_python

TextModel = Callable[[list[str]], list[str]]


def text_model(make_model: Callable[[], TextModel], prompt: Column, batch_size: int = 150) -> Column:
    """Call a text model on a prompt column; the model is made once per task."""

    @F.pandas_udf("string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for batch in batches:
            texts = batch.tolist()
            out: list[str] = []
            for start in range(0, len(texts), batch_size):
                out += model(texts[start : start + batch_size])
            yield pd.Series(out, dtype=object)

    return call(prompt)


def retrieve(
    queries: DataFrame, corpus: DataFrame, k: int,
    use_mmr: bool = False, mmr_fetch: int = 20, mmr_balance: float = 0.5, **search,
) -> DataFrame:
    """`(query_id, rank, score, chunk_id, doc_uri, text)` of each query's chunks.

    The ranks are stored before texts are joined: they are few, narrow and dear
    to compute, and their number decides how the texts are looked up.
    """
    ranked = nearest(queries, corpus, mmr_fetch if use_mmr else k, **search)
    ranked = freeze_python(ranked, "ranked")
    if use_mmr:
        with_vectors = lookup_join(ranked, corpus.select("chunk_id", "embedding"), "chunk_id")
        ranked = freeze_python(mmr_rerank(with_vectors, k, mmr_balance), "reranked")
    found = lookup_join(ranked, corpus.select("chunk_id", "doc_uri", "text"), "chunk_id")
    return found.select("query_id", "rank", "score", "chunk_id", "doc_uri", "text")


def contexts(retrieved: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Context text, best passage and document list of each query (k rows each)."""
    entry = F.struct("rank", "text", "doc_uri")
    gathered = retrieved.groupBy(query_id).agg(F.array_sort(F.collect_list(entry)).alias("_d"))
    return gathered.select(
        query_id,
        chat.join_context(F.col("_d.text")).alias("context"),
        F.col("_d")[0]["text"].alias("best_text"),
        F.col("_d.doc_uri").alias("doc_uris"),
    )


def prepare_questions(
    requests: DataFrame, config: AnswerConfig = AnswerConfig(),
    make_rewriter: Callable[[], TextModel] | None = None,
    rewrite_template: str = "Earlier turns:\n{chat_history}\n\nWrite one search query for: {question}",
) -> DataFrame:
    """Requests with question, history and retrieval query of their `messages`.

    The query joins the last turns with the question; `make_rewriter` lets a
    model write it instead.
    """
    prepared = requests.select(
        "*",
        chat.question("messages").alias("question"),
        chat.render(chat.history("messages")).alias("chat_history"),
    )
    if make_rewriter is None:
        query = chat.retrieval_query("messages", config.history_turns)
    else:
        query = text_model(
            make_rewriter,
            fill_template(rewrite_template, chat_history="chat_history", question="question"),
        )
    return prepared.withColumn("query", query)


def answer_batch(
    requests: DataFrame,
    corpus: DataFrame,
    config: AnswerConfig = AnswerConfig(),
    make_model: Callable[[], TextModel] | None = None,
    make_rewriter: Callable[[], TextModel] | None = None,
    make_embedder: Callable[[], Embedder] | None = None,
) -> DataFrame:
    """The request rows with question, context, prompt, output and documents.

    `requests` has `request_id` and `messages`; other columns are kept.
    `corpus` should be a written chunk table. Equal queries are embedded and
    searched once. Without a model the answer is the best passage. Requests for
    which nothing is found keep an empty context.
    """
    keyed = prepare_questions(requests, config, make_rewriter).withColumn("query_id", F.sha2("query", 256))
    prepared = freeze(keyed, "questions")
    asked = prepared.filter(F.length("query") > 0).groupBy("query_id").agg(F.first("query").alias("query"))
    embedded = embed_text(
        # The instruction is for models; as plain words it would be in every query and in no chunk.
        asked, "query", "query_vector", config.corpus.embed_dim,
        config.query_instruction if make_embedder else None, make_embedder,
        config.corpus.embed_batch,
    )
    queries = freeze_python(embedded.select("query_id", "query_vector"), "queries")
    found = retrieve(
        queries, corpus, config.k, config.use_mmr, config.mmr_fetch, config.mmr_balance
    )
    joined = salted_join(prepared, contexts(found), "query_id", "left")
    template = f"{config.system_template}\n\n{config.answer_template}"
    prompt = fill_template(
        template, chat_history="chat_history", context="context", question="question"
    )
    with_prompt = joined.withColumn("prompt", prompt)
    output = F.col("best_text") if make_model is None else text_model(make_model, F.col("prompt"))
    return with_prompt.select(
        *requests.columns, "question", "context", "prompt", output.alias("output"), "doc_uris"
    )
