"""Operator parameters, in one place."""

from __future__ import annotations

from dataclasses import dataclass, field

# Sizes and cut-offs that results depend on.
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50
MIN_CHUNK_SIZE = 20
EMBED_BATCH = 150
RETRIEVE_K = 5
SAMPLE_REQUESTS = 10
TOP_EXAMPLES = 5
QUERY_INSTRUCTION = "Represent this sentence for searching relevant passages:"
ARTICLE_CONTAINER = ("div", "itemprop", "articleBody")
SECTION_HEADER = "h2"

SYSTEM_TEMPLATE = (
    "You are a helpful assistant. If you do not know the answer, say so."
)
ANSWER_TEMPLATE = (
    "Discussion so far: {chat_history}\n\n"
    "Context that may help: {context}\n\n"
    "Answer briefly and directly: {question}"
)


@dataclass(frozen=True)
class CorpusConfig:
    chunk_size: int = CHUNK_SIZE
    chunk_overlap: int = CHUNK_OVERLAP
    min_chunk_size: int = MIN_CHUNK_SIZE
    container: tuple[str, str | None, str | None] = ARTICLE_CONTAINER
    header: str = SECTION_HEADER
    embed_dim: int = 256
    embed_instruction: str = ""
    embed_batch: int = EMBED_BATCH


@dataclass(frozen=True)
class AnswerConfig:
    k: int = RETRIEVE_K
    use_mmr: bool = False
    mmr_fetch: int = 20
    mmr_balance: float = 0.5
    history_turns: int = 3
    query_instruction: str = QUERY_INSTRUCTION
    system_template: str = SYSTEM_TEMPLATE
    answer_template: str = ANSWER_TEMPLATE
    corpus: CorpusConfig = field(default_factory=CorpusConfig)
