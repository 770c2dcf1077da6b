"""Pages to an embedded, identified chunk table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..config import CorpusConfig
from ..operators.chunking import chunk_pages, sliding_chunks, with_chunk_id
from ..operators.embed import Embedder, embed_text


def build_corpus(
    pages: DataFrame,
    config: CorpusConfig = CorpusConfig(),
    make_embedder: Callable[[], Embedder] | None = None,
    token_counter: Callable[[str], int] | None = None,
) -> DataFrame:
    """`(chunk_id, doc_uri, text, embedding)` of all article chunks; no shuffle.

    Lazy until written. Write it once before searching it.
    """
    chunks = chunk_pages(pages.select("doc_uri", "html_content"), config, token_counter=token_counter)
    return _finish(chunks, config, make_embedder)


def build_text_corpus(
    docs: DataFrame,
    config: CorpusConfig = CorpusConfig(),
    make_embedder: Callable[[], Embedder] | None = None,
) -> DataFrame:
    """The same table from plain texts `(doc_uri, content)`, by token windows."""
    return _finish(sliding_chunks(docs, "content", config), config, make_embedder)


def _finish(chunks: DataFrame, config: CorpusConfig, make_embedder) -> DataFrame:
    embedded = embed_text(
        with_chunk_id(chunks), "text", "embedding", config.embed_dim,
        config.embed_instruction, make_embedder, config.embed_batch,
    )
    return embedded.select("chunk_id", "doc_uri", "text", "embedding")
