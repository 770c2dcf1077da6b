"""Line-first quality rules, with built-in expressions only.

Every line with a word meets three rules: punctuation (it ends like a
sentence unless it is long, and is not riddled with runs of symbols), navigation (it is not a row of
separated labels) and boilerplate (it is not a short notice made of stock
phrases). Lines that fail are removed; a document that loses more than
`max_lost` of its words is rejected, as is one that fails the base rules (fewer
than `min_words` words, or more than half of its words in repeated 3-word
windows). Whole texts are read; nothing is shuffled.

Null text counts as empty: no words, base failed, clean text null. A line
without a word is kept as it is. Columns of the same name as a result are kept
under their own name; the result then gets underscores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import let
from . import words as W
from .scratch import column, free_name

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST = 0.4
LONG_LINE = 20
SYMBOL_RUN_SHARE = 0.3
SEPARATOR_SHARE = 0.2
NOTICE_WORDS = 30

RULES = ("punctuation", "navigation", "boilerplate")

# Fixed patterns, the same in Java's and RE2's syntax.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
SENTENCE_END = "[.!?…:;,\"'”’»)\\]。！？؟।][\\x20\\x09-\\x0D]*\\z"
SYMBOL_RUN = r"[!?*#$%&~^=_]{2,}"
SEPARATOR = r"[\x20\x09-\x0D][|»›>•·][\x20\x09-\x0D]"
STOCK_PHRASES = (
    "(?i)(all rights reserved|privacy policy|terms of (use|service)|cookie (policy|settings)"
    "|we use cookies|enable javascript|javascript is disabled|sign up for our newsletter"
    "|subscribe to our|click here|skip to (main )?content|back to top|add to cart|powered by)"
)


def repeat_words(words: Column) -> Column:
    """Words that lie in 3-word windows found twice or more in the array.

    Windows are compared by a 64-bit hash of their three words, within one text.
    """
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )

    def count(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            again = F.filter(
                s, lambda x, i: (F.get(s, i + 1)["h"] == x["h"]) | ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
            )
            covered = F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
            return F.size(F.array_distinct(covered))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(ordered, twice))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(hashes, count)).cast("long")


def base_counts(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    return {
        "n_words": F.regexp_count(t, F.lit(WORD)).cast("long"),
        "word_chars": F.char_length(F.regexp_replace(t, W.BLANKS, "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": let(W.native_words(t), repeat_words),
    }


def line_verdict(line: Column) -> Column:
    """(line, words, rule): rule is the first one the line fails, or null."""
    words = F.regexp_count(line, F.lit(WORD))
    runs = F.regexp_count(line, F.lit(SYMBOL_RUN))
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    rule = (
        F.when(separators > SEPARATOR_SHARE * words, "navigation")
        .when(
            ((words < LONG_LINE) & ~line.rlike(SENTENCE_END)) | (runs > SYMBOL_RUN_SHARE * words), "punctuation"
        )
        .when((words <= NOTICE_WORDS) & line.rlike(STOCK_PHRASES), "boilerplate")
    )
    return F.struct(line.alias("line"), words.alias("words"), F.when(words > 0, rule).alias("rule"))


def _failures(verdicts: Column, rule: str) -> Column:
    return F.size(F.filter(verdicts, lambda x: x["rule"] == rule))


def judge(docs: DataFrame, text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """`docs` with base counts, line results and the verdict.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, clean_text, n_lost_words, failed_lines (count by rule) and kept.
    """
    text = column(text_col)
    names: dict[str, str] = {}
    for name in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "clean_text", "n_lost_words", "failed_lines", "kept", "line_results",
    ):
        names[name] = free_name(name, docs.columns)
    lines = let(
        F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), line_verdict),
        lambda v: F.struct(
            F.array_join(F.transform(F.filter(v, lambda x: x["rule"].isNull()), lambda x: x["line"]), "\n").alias("text"),
            F.aggregate(
                F.filter(v, lambda x: x["rule"].isNotNull()), F.lit(0).cast("long"), lambda a, x: a + x["words"]
            ).alias("lost"),
            F.struct(*[_failures(v, rule).alias(rule) for rule in RULES]).alias("failed"),
        ),
    )
    out = docs.withColumns(
        {names[k]: v for k, v in base_counts(text).items()} | {names["line_results"]: lines}
    )
    result = column(names["line_results"])
    n_words, n_repeat = column(names["n_words"]), column(names["n_repeat_words"])
    base_failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    lost = result["lost"]
    return out.withColumns({
        names["base_failed"]: base_failed,
        names["clean_text"]: F.when(text.isNotNull(), result["text"]),
        names["n_lost_words"]: lost,
        names["failed_lines"]: result["failed"],
        names["kept"]: ~base_failed & (lost <= max_lost * n_words),
    }).drop(names["line_results"])


def clean(docs: DataFrame, text_col: str = "text", chars_col: str | None = None, **options) -> DataFrame:
    """Kept rows with their own columns, the text cut to its good lines.

    `chars_col` names a column that holds the text's length and is renewed.
    """
    judged = judge(docs.select(*[column(c) for c in docs.columns]), text_col, **options)
    added = judged.columns[len(docs.columns):]
    by_name = {a.rstrip("_"): a for a in added}
    kept = judged.filter(column(by_name["kept"]))
    text = column(by_name["clean_text"])
    changed = {text_col: text}
    if chars_col:
        changed[chars_col] = F.char_length(text).cast("long")
    return kept.select(*[changed.get(c, column(c)).alias(c) for c in docs.columns])
