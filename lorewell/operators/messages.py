"""Message rows to message arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .joins import salted_join
from .ranking import top_per_group


def assemble_messages(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """One `messages` array per conversation, in turn order.

    The array is one value of one row, as every consumer of `messages` needs
    it. `questions`, `history_rows` and `retrieval_queries` give the parts of
    conversations of any length without gathering them.
    """
    entry = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"))
    gathered = rows.groupBy(conversation).agg(F.array_sort(F.collect_list(entry)).alias("_m"))
    plain = F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return gathered.select(conversation, plain.alias("messages"))


def last_messages(
    rows: DataFrame, n: int, conversation: str = "conv_id", turn: str = "turn", rank: str = "back"
) -> DataFrame:
    """The last `n` message rows of each conversation; `back` 1 is the last.

    Works on rows, so a conversation of any length costs `n` rows per task.
    """
    return top_per_group(rows, [conversation], [F.col(turn).desc()], n, rank)


def questions(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", text: str = "text"
) -> DataFrame:
    """The last message of each conversation, by a map-side combined aggregate."""
    return rows.groupBy(conversation).agg(F.max_by(text, turn).alias("question"))


def history_rows(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """All message rows before the last one of their conversation."""
    ends = rows.groupBy(conversation).agg(F.max(turn).alias("_last"))
    return salted_join(rows, ends, conversation).filter(F.col(turn) < F.col("_last")).drop("_last")


def retrieval_queries(
    rows: DataFrame, n_turns: int, conversation: str = "conv_id", turn: str = "turn", text: str = "text"
) -> DataFrame:
    """Last `n_turns` history messages and the question as one query text."""
    recent = last_messages(rows, n_turns + 1, conversation, turn)
    entry = F.struct(F.col(turn).alias("t"), F.col(text).alias("c"))
    gathered = recent.groupBy(conversation).agg(F.array_sort(F.collect_list(entry)).alias("_m"))
    joined = F.array_join(F.transform("_m", lambda m: m["c"]), " ")
    return gathered.select(conversation, joined.alias("query"))
