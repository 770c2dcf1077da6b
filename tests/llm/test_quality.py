import re

from llm_help import words

from lorewell.llm import quality


def base(text):
    text = text or ""
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    repeat = {i + j for i, g in enumerate(grams) if seen[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat))


def verdict(text):
    if text is None:
        return None, 0
    kept, lost = [], 0
    for line in text.split("\n"):
        n = len(words(line))
        bad = n > 0 and bool(
            len(re.findall(quality.SEPARATOR, line)) > quality.SEPARATOR_SHARE * n
            or (n < quality.LONG_LINE and not re.search(quality.SENTENCE_END.replace(r"\z", r"\Z"), line))
            or len(re.findall(quality.SYMBOL_RUN, line)) > quality.SYMBOL_RUN_SHARE * n
            or (n <= quality.NOTICE_WORDS and re.search(quality.STOCK_PHRASES, line))
        )
        lost += n * bad
        if not bad:
            kept.append(line)
    return "\n".join(kept), lost


PROSE = "The river rose in the night and the town woke to find the lower streets under water, with boats tied to doors."
PAGE = "\n".join([PROSE] * 3 + [
    "Home | About | News | Contact",
    "Read more",
    "We use cookies to improve the site. Privacy policy.",
    "buy!!! now!!! cheap!!! here!!!",
    "",
    "Heavy rain had fallen for nine days.",
])


def test_base_counts_and_verdict(spark, odd_docs):
    docs = odd_docs.unionByName(spark.createDataFrame([(900, PAGE), (901, PROSE)], "doc_id long, text string"), allowMissingColumns=True)
    rows = quality.judge(docs).collect()
    for r in rows:
        assert (r["n_words_"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base(r["text"])
        failed = r["n_words_"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words_"]
        text, lost = verdict(r["text"])
        assert (r["base_failed"], r["clean_text_"], r["n_lost_words"]) == (failed, text, lost)
        assert r["kept_"] == (not failed and lost <= quality.MAX_LOST * r["n_words_"])
    page = next(r for r in rows if r["doc_id"] == 900)
    assert page["clean_text_"].split("\n") == [PROSE] * 3 + ["", "Heavy rain had fallen for nine days."]
    assert page["failed_lines"].asDict() == {"punctuation": 2, "navigation": 1, "boilerplate": 1}


def test_clean_renews_text_and_length(spark):
    text = "\n".join([f"Sentence {i} speaks{i} of{i} matter{i} and ends like{i} all{i} should." for i in range(9)] + ["Read more"])
    docs = spark.createDataFrame([(1, text, 0), (2, "short", 0), (3, None, 0)], "doc_id long, text string, n_chars long")
    rows = quality.clean(docs, chars_col="n_chars").collect()
    kept = text.rsplit("\n", 1)[0]
    assert [tuple(r) for r in rows] == [(1, kept, len(kept))]
    assert quality.clean(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, odd_docs):
    plan = quality.judge(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
