"""The same results in SQL, over the same Parquet tables."""

from __future__ import annotations

from lorewell.config import ANSWER_TEMPLATE
from lorewell.operators.metrics import HARM_TERMS
from lorewell.schemas import RANK_CUTOFFS

REQUESTS = """rl AS (
    SELECT CAST(doc_id AS VARCHAR) AS request_id,
           concat('models:/app/', CAST(doc_id % 3 + 1 AS VARCHAR)) AS rag_version,
           CAST(doc_id % 3 + 1 AS VARCHAR) AS version_number,
           text AS output, n_chars
    FROM documents)"""

TOKENS = r"len(regexp_extract_all({0}, '\S+'))"

PERFORMANCE = f"""pf AS (
    SELECT CAST(doc_id AS VARCHAR) AS request_id, 's0' AS step_id,
           n_chars * CAST(0.25 AS DOUBLE) AS latency, CAST(NULL AS DOUBLE) AS token_count FROM documents
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR), 's1', NULL, CAST({TOKENS.format('text')} AS DOUBLE) FROM documents)"""


def _hundredth(factor: int) -> str:
    return f"CAST(doc_id * {factor} % 101 AS DOUBLE) / 100"


VERDICTS = {
    "harmful": (
        "CASE WHEN doc_id % 11 <> 0 THEN CAST(toxic = 1 AS INTEGER) END",
        f"CASE WHEN doc_id % 7 <> 0 THEN {_hundredth(37)} END",
        "value IS NOT NULL OR score IS NOT NULL",
    ),
    "relevant": (
        "CASE WHEN doc_id % 5 <> 0 THEN CAST(quality = 1 AS INTEGER) END",
        _hundredth(53),
        "value IS NOT NULL",
    ),
    "faithful": (
        "CAST(doc_id * 29 % 101 >= 50 AS INTEGER)",
        _hundredth(29),
        "value IS NOT NULL OR score IS NOT NULL",
    ),
}


def _rated(metric: str) -> str:
    value, score, present = VERDICTS[metric]
    return f"""{REQUESTS},
    marks AS (SELECT CAST(doc_id AS VARCHAR) AS request_id, 's2' AS step_id, 'human' AS assessment_source,
                     {value} AS value, {score} AS score FROM labels),
    rated AS (SELECT m.*, rl.rag_version, rl.version_number, rl.output
              FROM marks m JOIN rl USING (request_id) WHERE {present})"""


def _generation_log(metric: str) -> str:
    return f"""WITH {_rated(metric)}
    SELECT request_id, step_id, rag_version, assessment_source, md5(output) AS output_md5,
           coalesce(value, -1) AS value, coalesce(score, CAST(-1 AS DOUBLE)) AS score FROM rated"""


def _share(metric: str) -> str:
    return f"""WITH {_rated(metric)}
    SELECT version_number AS rag_version, round(avg(CAST(value AS DOUBLE)), 6) AS true_share,
           round(avg(score), 6) AS mean_score, count(*) AS n_rows
    FROM rated GROUP BY version_number"""


def _quantiles(metric: str) -> str:
    return f"""WITH {_rated(metric)}
    SELECT version_number AS rag_version, count(score) AS n_scores,
           round(quantile_cont(score, 0.0), 6) AS score_min, round(quantile_cont(score, 0.25), 6) AS score_q1,
           round(quantile_cont(score, 0.5), 6) AS score_median, round(quantile_cont(score, 0.75), 6) AS score_q3,
           round(quantile_cont(score, 1.0), 6) AS score_max
    FROM rated WHERE score IS NOT NULL GROUP BY version_number"""


def _examples(metric: str) -> str:
    return f"""WITH {_rated(metric)},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY rag_version
                         ORDER BY score ASC NULLS FIRST, step_id, assessment_source,
                                  value ASC NULLS FIRST, request_id, output) AS row_num FROM rated)
    SELECT request_id, rag_version, row_num, md5(output) AS output_md5,
           coalesce(score, CAST(-1 AS DOUBLE)) AS score
    FROM ranked WHERE row_num <= 5"""


def _rank_rows() -> str:
    branches = []
    for k in RANK_CUTOFFS:
        known = f"CASE WHEN doc_id % {k + 1} <> 0 THEN"
        branches.append(
            f"""SELECT CAST(doc_id AS VARCHAR) AS request_id, 's3' AS step_id, 'automatic' AS assessment_source,
                {k} AS k, {known} {_hundredth(31 + k)} END AS retrieval_recall_at_k_score,
                {known} {_hundredth(41 + k)} END AS retrieval_precision_at_k_score,
                {known} {_hundredth(61 + k)} END AS retrieval_ndcg_at_k_score FROM labels"""
        )
    return f"""{REQUESTS},
    wide AS ({' UNION ALL '.join(branches)}),
    ranks AS (SELECT w.*, rl.rag_version, rl.version_number AS rag_version_number
              FROM wide w JOIN rl USING (request_id)
              WHERE coalesce(retrieval_recall_at_k_score, retrieval_precision_at_k_score,
                             retrieval_ndcg_at_k_score) IS NOT NULL)"""


NEIGHBOURS = """e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
    pairs AS (SELECT q.vec_id AS query_id, c.vec_id AS chunk_id, q.label = c.label AS relevant,
                     q.label AS query_label, round(list_dot_product(q.v, c.v), 9) AS score
              FROM e q JOIN e c ON q.vec_id <> c.vec_id),
    placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
               FROM pairs),
    top AS (SELECT * FROM placed WHERE rank <= 5)"""

KNN = f"""WITH {NEIGHBOURS}
    SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM top"""


def _retrieval_metrics() -> str:
    columns = []
    for k in RANK_CUTOFFS:
        hits = f"sum(CASE WHEN rank <= {k} AND relevant THEN 1.0 ELSE 0.0 END)"
        gain = f"sum(CASE WHEN rank <= {k} AND relevant THEN 1.0 / log2(rank + 1) ELSE 0.0 END)"
        ideal = " + ".join(
            f"(CASE WHEN n >= {i} THEN 1.0 / log2({i + 1}) ELSE 0.0 END)" for i in range(1, k + 1)
        )
        columns += [
            f"round(CAST({hits} AS DOUBLE) / {k}, 6) AS retrieval_precision_at_{k}",
            f"round(CAST({hits} AS DOUBLE) / nullif(max(n), 0), 6) AS retrieval_recall_at_{k}",
            f"round(CASE WHEN max(n) > 0 THEN {gain} / max({ideal}) END, 6) AS retrieval_ndcg_at_{k}",
        ]
    return f"""WITH {NEIGHBOURS},
    sizes AS (SELECT label, count(*) - 1 AS n FROM e GROUP BY label)
    SELECT query_id, {', '.join(columns)}
    FROM top JOIN sizes ON top.query_label = sizes.label GROUP BY query_id"""


def _truth_metrics() -> str:
    columns = []
    for k in RANK_CUTOFFS:
        hits = f"sum(CASE WHEN rank <= {k} AND t.doc IS NOT NULL THEN 1.0 ELSE 0.0 END)"
        gain = f"sum(CASE WHEN rank <= {k} AND t.doc IS NOT NULL THEN 1.0 / log2(rank + 1) ELSE 0.0 END)"
        ideal = " + ".join(
            f"(CASE WHEN n >= {i} THEN 1.0 / log2({i + 1}) ELSE 0.0 END)" for i in range(1, k + 1)
        )
        columns += [
            f"round(CAST({hits} AS DOUBLE) / {k}, 6) AS retrieval_precision_at_{k}",
            f"round(CAST({hits} AS DOUBLE) / max(n), 6) AS retrieval_recall_at_{k}",
            f"round({gain} / max({ideal}), 6) AS retrieval_ndcg_at_{k}",
        ]
    return f"""WITH {NEIGHBOURS},
    truth AS (SELECT vec_id AS query_id, vec_id + 1 AS doc FROM e
              UNION SELECT vec_id, vec_id + 2 FROM e
              UNION SELECT query_id, chunk_id FROM top WHERE rank = 1),
    sizes AS (SELECT query_id, count(*) AS n FROM truth GROUP BY query_id)
    SELECT top.query_id, {', '.join(columns)}
    FROM top JOIN sizes ON top.query_id = sizes.query_id
    LEFT JOIN truth t ON top.query_id = t.query_id AND top.chunk_id = t.doc
    GROUP BY top.query_id"""


def _mmr(fetch: int, k: int, balance: float) -> str:
    """Greedy re-ranking, one step per kept row."""
    steps = ["picked1 AS (SELECT query_id, chunk_id, score, v, 1 AS rank FROM cand WHERE place = 1)"]
    for i in range(2, k + 1):
        before = " UNION ALL ".join(f"SELECT * FROM picked{j}" for j in range(1, i))
        steps.append(f"""picked{i} AS (
            SELECT query_id, chunk_id, score, v, {i} AS rank FROM (
                SELECT c.query_id, c.chunk_id, c.score, c.v, row_number() OVER (PARTITION BY c.query_id ORDER BY
                       {balance} * c.score - {1 - balance} * max(list_dot_product(c.v, p.v)) DESC, c.place) AS best
                FROM cand c JOIN ({before}) p ON c.query_id = p.query_id
                GROUP BY c.query_id, c.chunk_id, c.score, c.v, c.place
                HAVING count(*) FILTER (WHERE p.chunk_id = c.chunk_id) = 0)
            WHERE best = 1)""")
    union = " UNION ALL ".join(f"SELECT * FROM picked{j}" for j in range(1, k + 1))
    return f"""WITH {NEIGHBOURS},
    cand AS (SELECT query_id, chunk_id, score, rank AS place, v
             FROM placed JOIN e ON chunk_id = vec_id WHERE rank <= {fetch}),
    {', '.join(steps)}
    SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM ({union})"""


# The chunks that can be found are the vectors whose document has a text.
CONTEXTS = """chunk AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, text
              FROM embeddings JOIN documents ON vec_id = doc_id),
    query AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    pairs AS (SELECT q.vec_id AS query_id, c.vec_id AS chunk_id, c.text,
                     round(list_dot_product(q.v, c.v), 9) AS score
              FROM query q JOIN chunk c ON q.vec_id <> c.vec_id),
    placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
               FROM pairs),
    ctx AS (SELECT query_id, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context,
                   max(CASE WHEN rank = 1 THEN text END) AS best
            FROM placed WHERE rank <= 5 GROUP BY query_id)"""

CHATS = """turns AS (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last_turn FROM conversations),
    chats AS (SELECT conv_id, count(*) AS n,
                     string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS chat,
                     coalesce(string_agg(CASE WHEN turn < last_turn THEN role || ': ' || text END, chr(10)
                                         ORDER BY turn), '') AS history,
                     max(CASE WHEN turn = last_turn THEN text END) AS question
              FROM turns GROUP BY conv_id)"""


def _prompt() -> str:
    pieces = ANSWER_TEMPLATE.replace("'", "''").replace("\n", "' || chr(10) || '")
    for name, column in (("chat_history", "history"), ("context", "context"), ("question", "question")):
        pieces = pieces.replace("{" + name + "}", f"' || coalesce({column}, '') || '")
    return f"'{pieces}'"


def _words(column: str) -> str:
    return rf"list_distinct(regexp_extract_all(lower({column}), '\S+'))"


PAIRS = """answers AS (SELECT a.conv_id, a.turn, a.text AS answer, b.text AS context
               FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1
               WHERE a.role = 'assistant')"""

SQUEEZE = (
    ("'<!--.*?-->'", "''", "s"),
    ("'<script\\b.*?</script\\s*>'", "''", "is"),
    ("'<style\\b.*?</style\\s*>'", "''", "is"),
)


def _article() -> str:
    page = "html"
    for pattern, to, flags in SQUEEZE:
        page = f"regexp_replace({page}, {pattern}, {to}, 'g{flags}')"
    body = f"regexp_extract({page}, '<article(\\s[^>]*)?>(.*?)(</article[\\s>]|$)', 2, 'is')"
    steps = (
        (r"'\s+'", "' '", ""),
        (
            r"'</?(p|br|div|li|ul|ol|tr|table|pre|section|article|blockquote|hr|h[1-6])\b[^>]*>'",
            "chr(10)",
            "i",
        ),
        (r"'</?[a-zA-Z!][^>]*>'", "''", ""),
        (r"' *\n\s*'", "chr(10)", ""),
        (r"' {2,}'", "' '", ""),
        (r"'^\s+'", "''", ""),
        (r"'\s+$'", "''", ""),
    )
    out = body
    for pattern, to, flags in steps:
        out = f"regexp_replace({out}, {pattern}, {to}, 'g{flags}')"
    for reference, char in (
        ("&nbsp;?", " "), ("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;?", "''"),
        ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&"),
    ):
        out = f"regexp_replace({out}, '{reference}', '{char}', 'g')"
    return f"SELECT url AS doc_uri, {out} AS article FROM pages"


def _page_chunk_tables(size: int, overlap: int, minimum: int) -> str:
    """The table `paged` with the chunks of the test pages, whose one section is the whole article.

    Articles over the limit are packed line by line. A line over the limit
    ends the run before it and is cut into word windows. Within a run, `c` adds
    up the tokens and `back` is where a chunk that opens at a line may begin:
    the earliest line from which the repeated lines fit the overlap and leave
    room. `walk` follows the open chunk (lines `a` to `i`) through the run.
    """
    step = size - overlap
    return rf"""WITH RECURSIVE art AS ({_article()}),
    sized AS (SELECT doc_uri, article, {TOKENS.format('article')} AS n FROM art),
    raw AS (SELECT doc_uri, unnest(string_split(article, chr(10))) AS line,
                   unnest(range(0, len(string_split(article, chr(10))))) AS seq
            FROM sized WHERE n > {size}),
    marked AS (SELECT *, {TOKENS.format('line')} AS n FROM raw WHERE line <> ''),
    runs AS (SELECT *, sum(CASE WHEN n >= {size} THEN 1 ELSE 0 END)
                       OVER (PARTITION BY doc_uri ORDER BY seq) AS run FROM marked),
    lines AS (SELECT doc_uri, run, seq, line, n,
                     row_number() OVER (PARTITION BY doc_uri, run ORDER BY seq) AS i,
                     CAST(sum(n) OVER (PARTITION BY doc_uri, run ORDER BY seq) AS BIGINT) AS c,
                     count(*) OVER (PARTITION BY doc_uri, run) AS last
              FROM runs WHERE n < {size}),
    backs AS (SELECT x.doc_uri, x.run, x.i,
                     coalesce(min(CASE WHEN (x.c - x.n) - (y.c - y.n) <= least({overlap}, {size} - x.n)
                                       THEN y.i END), x.i) AS back
              FROM lines x JOIN lines y ON x.doc_uri = y.doc_uri AND x.run = y.run AND y.i < x.i
              GROUP BY x.doc_uri, x.run, x.i),
    steps AS (SELECT l.*, coalesce(b.back, l.i) AS back, l.c - l.n AS before
              FROM lines l LEFT JOIN backs b ON l.doc_uri = b.doc_uri AND l.run = b.run AND l.i = b.i),
    walk AS (SELECT doc_uri, run, i, i AS a, before AS base, c, last, CAST(NULL AS BIGINT) AS done_a FROM steps WHERE i = 1
             UNION ALL
             SELECT s.doc_uri, s.run, s.i,
                    CASE WHEN s.c - w.base > {size} THEN greatest(w.a, s.back) ELSE w.a END,
                    CASE WHEN s.c - w.base > {size} THEN f.before ELSE w.base END,
                    s.c, s.last, CASE WHEN s.c - w.base > {size} THEN w.a END
             FROM walk w JOIN steps s ON s.doc_uri = w.doc_uri AND s.run = w.run AND s.i = w.i + 1
             JOIN steps f ON f.doc_uri = s.doc_uri AND f.run = s.run AND f.i = greatest(w.a, s.back)),
    spans AS (SELECT doc_uri, run, done_a AS a, i - 1 AS b FROM walk WHERE done_a IS NOT NULL
              UNION ALL SELECT doc_uri, run, a, i FROM walk WHERE i = last),
    packed AS (SELECT s.doc_uri, min(l.seq) AS first_line, s.b AS then_by, string_agg(l.line, chr(10) ORDER BY l.i) AS text
               FROM spans s JOIN lines l ON l.doc_uri = s.doc_uri AND l.run = s.run AND l.i BETWEEN s.a AND s.b
               GROUP BY s.doc_uri, s.run, s.a, s.b),
    long AS (SELECT doc_uri, seq, regexp_extract_all(line, '\S+') AS w FROM runs WHERE n >= {size}),
    cuts AS (SELECT doc_uri, seq, w, unnest(range(0, len(w), {step})) AS s FROM long),
    chunks AS (SELECT doc_uri, 0 AS first_line, 0 AS then_by, article AS text FROM sized WHERE n <= {size}
               UNION ALL SELECT * FROM packed
               UNION ALL SELECT doc_uri, seq, s, array_to_string(w[s + 1 : s + {size}], ' ') FROM cuts
                         WHERE s = 0 OR s + {overlap} < len(w)),
    kept AS (SELECT *, {TOKENS.format('text')} AS n_tokens FROM chunks),
    paged AS (SELECT doc_uri, row_number() OVER (PARTITION BY doc_uri ORDER BY first_line, then_by) - 1 AS pos,
                     text, n_tokens
              FROM kept WHERE n_tokens > {minimum})"""


def _page_chunks(size: int, overlap: int, minimum: int) -> str:
    tables = _page_chunk_tables(size, overlap, minimum)
    return f"{tables} SELECT doc_uri, pos, md5(text) AS text_md5, n_tokens FROM paged"


def _slots(name: str, source: str, key: str, text: str) -> str:
    """Table `name` with the nonzero slots of hashed bag-of-words vectors."""
    return rf"""{name}_counts AS (
        SELECT key, CAST(concat('0x', left(md5(w), 7)) AS BIGINT) % 256 AS slot, count(*) AS n
        FROM (SELECT {key} AS key, unnest(regexp_extract_all(lower({text}), '\S+')) AS w FROM {source})
        GROUP BY key, slot),
    {name} AS (SELECT key, slot, CAST(n / sqrt(sum(n * n) OVER (PARTITION BY key)) AS FLOAT) AS v FROM {name}_counts)"""


VECTOR_MD5 = """md5(coalesce(string_agg(concat(CAST(slot AS VARCHAR), ':',
    CAST(CAST(round(CAST(v AS DOUBLE) * 1000000) AS BIGINT) AS VARCHAR)), ',' ORDER BY slot), ''))"""


def _corpus(tables: str, chunks: str) -> str:
    return f"""{tables},
    identified AS (SELECT sha256(concat_ws('|', doc_uri, CAST(pos AS VARCHAR), text)) AS chunk_id, doc_uri, text FROM {chunks}),
    {_slots('vectors', '(SELECT DISTINCT chunk_id, text FROM identified)', 'chunk_id', 'text')}
    SELECT chunk_id, doc_uri, text, {VECTOR_MD5} AS embedding_md5
    FROM identified JOIN vectors ON chunk_id = key GROUP BY chunk_id, doc_uri, text"""


def _prediction_tables() -> str:
    """`ranked`: every conversation's last messages against all page chunks."""
    return f"""{_page_chunk_tables(500, 50, 20)},
    identified AS (SELECT sha256(concat_ws('|', doc_uri, CAST(pos AS VARCHAR), text)) AS chunk_id, doc_uri, text FROM paged),
    placed_turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations),
    asked AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS query FROM placed_turns WHERE back <= 4 GROUP BY conv_id),
    {_slots('cv', 'identified', 'chunk_id', 'text')},
    {_slots('qv', 'asked', 'conv_id', 'query')},
    scores AS (SELECT q.key AS conv_id, c.key AS chunk_id, sum(CAST(q.v AS DOUBLE) * CAST(c.v AS DOUBLE)) AS score
               FROM qv q JOIN cv c ON q.slot = c.slot GROUP BY q.key, c.key),
    ranked AS (SELECT a.conv_id, i.doc_uri, i.text,
                      row_number() OVER (PARTITION BY a.conv_id ORDER BY round(coalesce(score, 0), 9) DESC, i.chunk_id) AS rank
               FROM asked a CROSS JOIN identified i
               LEFT JOIN scores s ON s.conv_id = a.conv_id AND s.chunk_id = i.chunk_id)"""


def _predictions() -> str:
    return f"""{_prediction_tables()}
    SELECT CAST(conv_id AS VARCHAR) AS request_id, 'models:/app/1' AS app_version_id,
           md5(max(CASE WHEN rank = 1 THEN text END)) AS output_md5,
           string_agg(doc_uri, ' ' ORDER BY rank) AS retrieved
    FROM ranked WHERE rank <= 5 GROUP BY conv_id"""


def _offline_ranks() -> str:
    """Rank metrics of the predictions; four pages are relevant for a conversation."""
    columns = []
    for k in RANK_CUTOFFS:
        hits = f"coalesce(sum(CASE WHEN rank <= {k} AND t.url IS NOT NULL THEN 1.0 ELSE 0.0 END), 0)"
        gain = f"sum(CASE WHEN rank <= {k} AND t.url IS NOT NULL THEN 1.0 / log2(rank + 1) ELSE 0.0 END)"
        ideal = " + ".join(f"(CASE WHEN n >= {i} THEN 1.0 / log2({i + 1}) ELSE 0.0 END)" for i in range(1, k + 1))
        columns += [
            f"round(CAST({hits} AS DOUBLE) / {k}, 6) AS precision_at_{k}",
            f"coalesce(round(CAST({hits} AS DOUBLE) / max(n), 6), -1) AS recall_at_{k}",
            f"coalesce(round(CASE WHEN max(n) > 0 THEN {gain} / max({ideal}) END, 6), -1) AS ndcg_at_{k}",
        ]
    return f"""{_prediction_tables()},
    truth AS (SELECT DISTINCT conv_id, url FROM asked JOIN pages ON page_id BETWEEN conv_id AND conv_id + 3),
    sizes AS (SELECT conv_id, count(*) AS n FROM truth GROUP BY conv_id)
    SELECT CAST(r.conv_id AS VARCHAR) AS request_id, {', '.join(columns)}
    FROM (SELECT * FROM ranked WHERE rank <= 5) r LEFT JOIN sizes ON r.conv_id = sizes.conv_id
    LEFT JOIN truth t ON t.conv_id = r.conv_id AND t.url = r.doc_uri GROUP BY r.conv_id"""


def _discrete_quantiles(metric: str) -> str:
    """Quantiles that are values of the data, as a sketch of enough accuracy gives."""
    at = ", ".join(
        f"round(max(CASE WHEN place = greatest(1, CAST(ceil({p} * n) AS BIGINT)) THEN score END), 6) AS {name}"
        for p, name in ((0.0, "score_min"), (0.25, "score_q1"), (0.5, "score_median"), (0.75, "score_q3"), (1.0, "score_max"))
    )
    return f"""WITH {_rated(metric)},
    placed AS (SELECT version_number, score, row_number() OVER (PARTITION BY version_number ORDER BY score) AS place,
                      count(*) OVER (PARTITION BY version_number) AS n
               FROM rated WHERE score IS NOT NULL)
    SELECT version_number AS rag_version, max(n) AS n_scores, {at} FROM placed GROUP BY version_number"""


def _windows(size: int, overlap: int) -> str:
    step = size - overlap
    return f"""words AS (SELECT concat('doc/', CAST(doc_id AS VARCHAR)) AS doc_uri,
                         regexp_extract_all(text, '\\S+') AS w FROM documents),
    starts AS (SELECT doc_uri, w, unnest(range(0, len(w), {step})) AS s FROM words WHERE len(w) > 0),
    windows AS (SELECT doc_uri, CAST(s / {step} AS BIGINT) AS pos, w[s + 1 : s + {size}] AS t FROM starts),
    chunks AS (SELECT doc_uri, pos, len(t) AS n_tokens, array_to_string(t, ' ') AS text
               FROM windows WHERE len(t) > 20)"""


FEEDBACK = "event_type = 'purchase'"
STAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
VERSION_OF_USER = "concat('models:/app/', CAST(user_id % 3 + 1 AS VARCHAR))"

# Ratings of the online run, one row each: the logged verdict of a feedback
# call, or the three computed metrics of a request.
ONLINE = f"""calls AS (SELECT *, concat('r', CAST(event_id AS VARCHAR)) AS rid FROM events WHERE NOT ({FEEDBACK})),
    rows AS (
      SELECT concat('u', CAST(user_id AS VARCHAR)) AS request_id, 'feedback' AS step_id, 'harmful' AS metric,
             CAST(value > 20 AS INTEGER) AS verdict, round(value, 6) AS score, ts, event_id
      FROM events WHERE {FEEDBACK}
      UNION ALL SELECT rid, 'eval', 'latency', -1, round(value * 10, 6), ts, event_id FROM calls
      UNION ALL SELECT rid, 'eval', 'token_count', -1, CAST({TOKENS.format('props')} AS DOUBLE), ts, event_id FROM calls
      UNION ALL SELECT rid, 'eval', 'harmful', 0, CAST(0 AS DOUBLE), ts, event_id FROM calls)"""

ASSESSMENT_ROWS = f"WITH {ONLINE} SELECT request_id, step_id, metric, verdict, score FROM rows"

HARM = f"""len(list_intersect(list_distinct(regexp_extract_all(lower({{0}}), '[a-z]+')),
           [{', '.join(repr(t) for t in HARM_TERMS)}])) / CAST({len(HARM_TERMS)} AS DOUBLE)"""

ORACLES = {
    "perf_by_version": f"""WITH {REQUESTS}, {PERFORMANCE}
        SELECT version_number AS rag_version, round(avg(latency), 6) AS avg_latency,
               round(avg(token_count), 6) AS avg_token_count
        FROM pf JOIN rl USING (request_id) GROUP BY version_number""",
    "performance_log": f"""WITH {REQUESTS}, {PERFORMANCE}
        SELECT request_id, step_id, latency, token_count, rag_version
        FROM pf JOIN rl USING (request_id)
        WHERE rag_version IN ('models:/app/1', 'models:/app/2')
          AND (latency IS NOT NULL OR token_count IS NOT NULL)""",
    "version_number": f"WITH {REQUESTS} SELECT request_id, version_number AS rag_version_number FROM rl",
    "nested_projection": f"""WITH {REQUESTS}
        SELECT request_id, rag_version, n_chars * CAST(0.25 AS DOUBLE) AS latency_ms, md5(output) AS output_md5
        FROM rl""",
    "version_filter": f"""WITH {REQUESTS} SELECT rag_version, count(*) AS n_requests FROM rl
        WHERE rag_version IN ('models:/app/1', 'models:/app/2') GROUP BY rag_version""",
    "assessment_request_join": f"""WITH {REQUESTS},
        al AS (SELECT CAST(doc_id AS VARCHAR) AS request_id, 's0' AS step_id, 'automatic' AS assessment_source FROM documents
               UNION ALL SELECT CAST(doc_id AS VARCHAR), 's1', 'automatic' FROM documents
               UNION ALL SELECT CAST(doc_id AS VARCHAR), 's2', 'human' FROM labels
               UNION ALL SELECT CAST(doc_id AS VARCHAR), 's3', 'automatic' FROM labels)
        SELECT request_id, step_id, assessment_source, rag_version FROM al JOIN rl USING (request_id)""",
    "distinct_versions": f"WITH {REQUESTS} SELECT DISTINCT rag_version AS app_version_id FROM rl",
    "retrieval_long": f"""WITH {_rank_rows()}
        SELECT request_id, step_id, rag_version, assessment_source, k, retrieval_recall_at_k_score,
               retrieval_precision_at_k_score, retrieval_ndcg_at_k_score, rag_version_number FROM ranks""",
    "retrieval_by_k_version": f"""WITH {_rank_rows()}
        SELECT rag_version_number AS rag_version, k, round(avg(retrieval_recall_at_k_score), 6) AS avg_recall,
               round(avg(retrieval_precision_at_k_score), 6) AS avg_precision,
               round(avg(retrieval_ndcg_at_k_score), 6) AS avg_ndcg
        FROM ranks GROUP BY rag_version_number, k""",
    "harmfulness_log": _generation_log("harmful"),
    "relevance_log": _generation_log("relevant"),
    "faithfulness_log": _generation_log("faithful"),
    "harmful_share": _share("harmful"),
    "relevant_share": _share("relevant"),
    "faithful_share": _share("faithful"),
    "score_quantiles": _quantiles("harmful"),
    "relevant_score_quantiles": _quantiles("relevant"),
    "faithful_score_quantiles": _quantiles("faithful"),
    "score_quantiles_approx": _discrete_quantiles("faithful"),
    "embed_hash": f"""WITH docs AS (SELECT concat('doc/', CAST(doc_id AS VARCHAR)) AS doc_uri, text FROM documents),
        {_slots('vectors', 'docs', 'doc_uri', 'text')}
        SELECT doc_uri, {VECTOR_MD5} AS embedding_md5 FROM docs LEFT JOIN vectors ON doc_uri = key GROUP BY doc_uri""",
    "corpus_build": _corpus(_page_chunk_tables(500, 50, 20), "paged"),
    "text_corpus_build": _corpus(f"WITH {_windows(500, 50)}", "chunks"),
    "offline_predictions": _predictions(),
    "offline_rank_metrics": _offline_ranks(),
    "report_over_view": f"""WITH {_rated('harmful')}
        SELECT version_number AS rag_version, count(*) AS n_rows, round(avg(CAST(value AS DOUBLE)), 6) AS true_share
        FROM rated WHERE value IS NOT NULL GROUP BY version_number""",
    "latency_quantiles": """SELECT lang, count(*) AS n_scores,
            round(quantile_cont(CAST(n_chars AS DOUBLE), 0.01), 6) AS p01,
            round(quantile_cont(CAST(n_chars AS DOUBLE), 0.5), 6) AS p50,
            round(quantile_cont(CAST(n_chars AS DOUBLE), 0.9), 6) AS p90,
            round(quantile_cont(CAST(n_chars AS DOUBLE), 0.99), 6) AS p99
        FROM documents GROUP BY lang""",
    "topk_harmful": _examples("harmful"),
    "bottomk_relevant": _examples("relevant"),
    "bottomk_faithful": _examples("faithful"),
    "pivot_versions": """SELECT CAST(doc_id AS VARCHAR) AS request_id, CAST(n_chars + 1 AS DOUBLE) AS v1,
            CAST(n_chars + 2 AS DOUBLE) AS v2, CAST(n_chars + 3 AS DOUBLE) AS v3 FROM documents""",
    "trace_samples": """SELECT CAST(doc_id AS VARCHAR) AS request_id, CAST(n_chars + 1 AS DOUBLE) AS v1,
            CAST(n_chars + 2 AS DOUBLE) AS v2, CAST(n_chars + 3 AS DOUBLE) AS v3
        FROM documents ORDER BY CAST(doc_id AS VARCHAR) LIMIT 10""",
    "sample_semi_join": """WITH ids AS (SELECT CAST(doc_id AS VARCHAR) AS request_id FROM documents
                     ORDER BY CAST(doc_id AS VARCHAR) LIMIT 10)
        SELECT request_id, concat('models:/app/', CAST(v AS VARCHAR)) AS app_version_id
        FROM ids, (VALUES (1), (2), (3)) AS versions(v)""",
    "review_queue": f"""WITH scores AS (
            SELECT CAST(doc_id AS VARCHAR) AS request_id,
                   concat('models:/app/', CAST(doc_id % 3 + 1 AS VARCHAR)) AS app_version_id,
                   {VERDICTS['harmful'][1]} AS harmful, {_hundredth(29)} AS faithful
            FROM labels WHERE quality = 0),
        placed AS (SELECT *, row_number() OVER (PARTITION BY app_version_id
                             ORDER BY faithful NULLS LAST, request_id) AS place FROM scores)
        SELECT request_id, app_version_id, place, coalesce(harmful, CAST(-1 AS DOUBLE)) AS harmful, faithful
        FROM placed WHERE place <= 10""",
    "sitemap_scan": "SELECT url AS doc_uri FROM pages",
    "page_fetch_join": "SELECT url AS doc_uri, md5(html) AS html_md5 FROM pages WHERE contains(html, '</html>')",
    "uri_relative_path": """SELECT url AS doc_uri, CASE WHEN starts_with(url, 'https://') THEN substr(url, 9)
            ELSE url END AS rel_path FROM pages""",
    "doc_store_round_trip": "SELECT url AS doc_uri, md5(html) AS html_md5 FROM pages",
    "article_text": _article(),
    "page_chunks": _page_chunks(500, 50, 20),
    "token_count": f"SELECT doc_id, CAST({TOKENS.format('text')} AS BIGINT) AS n_tokens FROM documents",
    "strip_text": r"""SELECT doc_id, md5(regexp_replace(regexp_replace(text,
            '^[\s\pZ\x0B\x{85}\x1c-\x1f]+', ''), '[\s\pZ\x0B\x{85}\x1c-\x1f]+$', '')) AS stripped_md5 FROM documents""",
    "chunk_sliding": f"WITH {_windows(500, 50)} SELECT doc_uri, pos, n_tokens, md5(text) AS text_md5 FROM chunks",
    "chunk_id_hash": f"""WITH {_windows(120, 20)} SELECT doc_uri,
            sha256(doc_uri || '|' || CAST(pos AS VARCHAR) || '|' || text) AS chunk_id FROM chunks""",
    "chunk_stats": f"""WITH {_windows(120, 20)} SELECT doc_uri, count(*) AS n_chunks,
            min(n_tokens) AS min_tokens, max(n_tokens) AS max_tokens FROM chunks GROUP BY doc_uri""",
    "index_delta": """SELECT sha256(concat('doc/', CAST(doc_id AS VARCHAR))) AS chunk_id,
            CASE WHEN quality = 1 THEN 'retire' ELSE 'add' END AS action
        FROM labels WHERE (quality = 1) <> (toxic = 0)""",
    "knn_exact_top5": KNN,
    "knn_grouped_top5": KNN,
    "knn_cells_top5": KNN,
    "retrieval_metrics": _retrieval_metrics(),
    "truth_metrics": _truth_metrics(),
    "mmr_rerank": _mmr(20, 5, 0.5),
    "rag_context": f"WITH {CONTEXTS} SELECT query_id, md5(context) AS context_md5 FROM ctx",
    "extractive_answer": f"WITH {CONTEXTS} SELECT query_id, md5(best) AS answer_md5 FROM ctx",
    "rag_prompt": f"""WITH {CONTEXTS}, {CHATS} SELECT conv_id, md5({_prompt()}) AS prompt_md5
        FROM chats JOIN ctx ON chats.conv_id = ctx.query_id""",
    "messages_array": f"WITH {CHATS} SELECT conv_id, n, md5(chat) AS chat_md5 FROM chats",
    "chat_question": f"WITH {CHATS} SELECT conv_id, question FROM chats",
    "chat_history": f"WITH {CHATS} SELECT conv_id, n - 1 AS n, md5(history) AS history_md5 FROM chats",
    "chat_history_rows": f"""WITH {CHATS} SELECT conv_id, turn, role, text FROM turns
        WHERE turn < last_turn""",
    "retrieval_query": """WITH back AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn
                      FROM conversations)
        SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS query FROM back WHERE rn <= 4 GROUP BY conv_id""",
    "metric_latency": "SELECT event_id, round(value * 1000, 3) AS latency_ms FROM events",
    "metric_token_count": f"""SELECT CAST(doc_id AS VARCHAR) AS request_id,
            CAST({TOKENS.format('text')} AS DOUBLE) AS token_count FROM documents""",
    "lexical_faithful": f"""WITH {PAIRS} SELECT conv_id, turn,
            round(CAST(len(list_intersect({_words('answer')}, {_words('context')})) AS DOUBLE)
                  / nullif(len({_words('answer')}), 0), 6) AS faithful FROM answers""",
    "lexical_relevant": f"""WITH {PAIRS}, {CHATS} SELECT a.conv_id, a.turn,
            round(CAST(len(list_intersect({_words('answer')}, {_words("question || ' ' || context")})) AS DOUBLE)
                  / nullif(len({_words('answer')}), 0), 6) AS relevant
        FROM answers a JOIN chats c ON a.conv_id = c.conv_id""",
    "answer_token_f1": f"""WITH ends AS (SELECT conv_id, arg_min(text, turn) AS answer, arg_max(text, turn) AS truth
                      FROM conversations WHERE role = 'assistant' GROUP BY conv_id)
        SELECT conv_id, round(2 * CAST(len(list_intersect({_words('answer')}, {_words('truth')})) AS DOUBLE)
               / nullif(len({_words('answer')}) + len({_words('truth')}), 0), 6) AS f1 FROM ends""",
    "harmful_terms": f"SELECT doc_id, round({HARM.format('text')}, 6) AS harm FROM documents",
    "run_eval_long": f"""SELECT CAST(doc_id AS VARCHAR) AS request_id, 'latency' AS metric, -1 AS verdict,
            round(n_chars * CAST(0.25 AS DOUBLE), 6) AS score FROM documents
        UNION ALL SELECT CAST(doc_id AS VARCHAR), 'token_count', -1,
            CAST({TOKENS.format('text')} AS DOUBLE) FROM documents
        UNION ALL SELECT CAST(doc_id AS VARCHAR), 'harmful', CAST({HARM.format('text')} > 0 AS INTEGER),
            round({HARM.format('text')}, 6) FROM documents""",
    "dedup_hourly": """WITH ranked AS (SELECT *, row_number() OVER (
                PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rn
            FROM events)
        SELECT user_id, event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00:00') AS hour, event_id, value
        FROM ranked WHERE rn = 1""",
    "versioned_overwrite": """WITH ranked AS (SELECT *, row_number() OVER (
                PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rn
            FROM events)
        SELECT user_id, event_type, event_id, value FROM ranked WHERE rn = 1""",
    "payload_unpack": f"""SELECT concat('r', CAST(event_id AS VARCHAR)) AS request_id,
            event_type || ' ' || props AS question, {STAMP} AS ts, {VERSION_OF_USER} AS app_version_id,
            round(value * 10, 6) AS latency_ms, props AS output
        FROM events WHERE NOT ({FEEDBACK})""",
    "payload_feedback": f"""SELECT concat('u', CAST(user_id AS VARCHAR)) AS request_id, 'feedback' AS step_id,
            'human' AS assessment_source, {STAMP} AS ts, CAST(value > 20 AS INTEGER) AS verdict, value AS score
        FROM events WHERE {FEEDBACK}""",
    "stream_payload_scan": f"""SELECT CASE WHEN {FEEDBACK} THEN concat('u', CAST(user_id AS VARCHAR))
                 ELSE concat('r', CAST(event_id AS VARCHAR)) END AS request_id,
            CASE WHEN {FEEDBACK} THEN 'assessment' ELSE 'request' END AS kind,
            CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, round(value * 10, 6) AS latency_ms
        FROM events""",
    "stream_split": f"""SELECT CASE WHEN {FEEDBACK} THEN 'assessment' ELSE 'request' END AS log, count(*) AS n
        FROM events GROUP BY 1""",
    "stream_union": ASSESSMENT_ROWS,
    "assessment_union": ASSESSMENT_ROWS,
    "stream_persist": f"""SELECT 'requests' AS log, count(*) AS n FROM events WHERE NOT ({FEEDBACK})
        UNION ALL SELECT 'assessments', count(*) FROM events""",
    "online_eval": f"""WITH {ONLINE}, ranked AS (SELECT *, row_number() OVER (
                PARTITION BY request_id, step_id, metric, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rn
            FROM rows)
        SELECT request_id, step_id, metric, verdict, score FROM ranked WHERE rn = 1""",
    "index_sync": """SELECT sha256(concat('doc/', CAST(doc_id AS VARCHAR))) AS chunk_id, doc_id,
            CAST(CASE WHEN quality = 1 THEN 1 ELSE 2 END AS BIGINT) AS batch FROM labels WHERE toxic = 0""",
    "stream_dedup_hourly": """WITH ranked AS (SELECT *, date_trunc('hour', ts) AS h,
                row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts)
                                   ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        SELECT user_id, event_type, strftime(h, '%Y-%m-%d %H:00:00') AS hour, event_id, value
        FROM ranked WHERE rn = 1""",
}
