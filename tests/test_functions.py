from lorewell.functions import chat, html, text
from pyspark.sql import functions as F

MESSAGES = "messages array<struct<role:string,content:string>>"


def one(df, column):
    return df.select(column).first()[0]


def test_text_columns(spark):
    df = spark.createDataFrame([("  \t a b \n",)], "t string")
    assert one(df, text.strip("t")) == "a b"
    assert one(df, text.version_number(F.lit("models:/app/12"))) == "12"
    assert one(df, text.version_number(F.lit("plain"))) == "plain"
    assert one(df, text.version_number(F.lit(None).cast("string"))) is None
    assert one(df, text.token_count(F.lit("a  b\nc"))) == 3
    assert one(df, text.token_count(F.lit(""))) == 0
    assert one(df, text.relative_path(F.lit("https://x/y"), "https://")) == "x/y"
    assert one(df, text.relative_path(F.lit("ftp://x"), "https://")) == "ftp://x"
    assert one(df, text.with_instruction(F.lit("q"), "find:")) == "find: q"
    assert one(df, text.with_instruction(F.lit("q"), "")) == "q"


def test_chunk_id_depends_on_every_part(spark):
    rows = [("u", 0, "t"), ("u", 1, "t"), ("v", 0, "t"), ("u", 0, "s")]
    df = spark.createDataFrame(rows, "u string, p int, t string")
    ids = [r[0] for r in df.select(text.chunk_id("u", "p", "t")).collect()]
    assert len(set(ids)) == 4
    assert ids == [r[0] for r in df.select(text.chunk_id("u", "p", "t")).collect()]


def test_template_does_not_fill_values(spark):
    df = spark.createDataFrame([("{question}", "what?", None)], "h string, q string, c string")
    filled = text.fill_template("H {chat_history} Q {question} C {context}.", chat_history="h", question="q", context="c")
    assert one(df, filled) == "H {question} Q what? C ."


def test_question_and_history(spark):
    three = [("user", "a"), ("assistant", "b"), ("user", "c")]
    df = spark.createDataFrame([(1, three), (2, three[:1]), (3, [])], f"id int, {MESSAGES}")
    rows = {
        r.id: r
        for r in df.select(
            "id",
            chat.question("messages").alias("q"),
            chat.render(chat.history("messages")).alias("h"),
            chat.retrieval_query("messages", 1).alias("rq"),
        ).collect()
    }
    assert (rows[1].q, rows[1].h, rows[1].rq) == ("c", "user: a\nassistant: b", "b c")
    assert (rows[2].q, rows[2].h, rows[2].rq) == ("a", "", "a")
    assert (rows[3].q, rows[3].h) == (None, "")


NESTED = (
    '<body><div class="x">no</div><div id=1 itemprop="articleBody">one<div>two</div>'
    "<script>var a='</div>'</script><!-- </div> -->three</div>after</body>"
)


def test_container_with_nested_elements(spark):
    df = spark.createDataFrame(
        [(1, NESTED), (2, "<p>none</p>"), (3, None), (4, '<div itemprop=articleBody>open<div>x</div>'),
         (5, '<div itemprop="articleBodyX">no</div>')],
        "id int, h string",
    )
    body = html.container_body("h", "div", "itemprop", "articleBody")
    rows = dict(df.select("id", body).collect())
    assert rows[1] == "one<div>two</div>three"
    assert rows[2] is None and rows[3] is None and rows[5] is None
    assert rows[4] == "open<div>x</div>"


def test_tag_names_are_not_prefixes(spark):
    df = spark.createDataFrame([("<article>a<articles>b</articles>c</article>d",)], "h string")
    assert one(df, html.container_body("h", "article")) == "a<articles>b</articles>c"


def test_visible_text(spark):
    df = spark.createDataFrame([("<p>a  b<p>c<br>d <b>e</b>f &amp;lt; 1 < 2</p>",)], "h string")
    assert one(df, html.decode_references(html.markup_to_text("h"))) == "a b\nc\nd ef &lt; 1 < 2"
    assert one(df, html.decode_references(F.lit("x &amp y &lt;"))) == "x & y <"


def test_sections(spark):
    df = spark.createDataFrame([("intro<h2 class=x>One <i>x</i></h2><p>a</p><H2>Two</H2>b",), ("only text",), ("<h2>bare</h2>",)], "h string")
    found = [[tuple(s) for s in r[0]] for r in df.select(html.sections("h", "h2")).collect()]
    assert found[0] == [("", "intro"), ("One x", "a"), ("Two", "b")]
    assert found[1] == [("", "only text")]
    assert found[2] == [("bare", "")]


HOSTILE_OPENERS = ["<!--", "<script>", "<style>", "<h2>", "<h2 ", "<article>", "<article ", "<p ", "<b ", "</h2", "<h2></h2 ", "<!"]


def test_html_time_grows_with_the_page(spark):
    """Pages of openers that are never closed take time in proportion to their size."""
    import time

    def took(opener, size):
        page = "<article>" + opener * (size // len(opener))
        df = spark.createDataFrame([(page,)], "h string").select(
            html.article_text("h", "article").alias("a"),
            html.sections(html.container_body("h", "article"), "h2").alias("s"),
        )
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for opener in HOSTILE_OPENERS:
        took(opener, 1000)
        small, large = took(opener, 500_000), took(opener, 1_000_000)
        assert large < 3 * small + 1 and large < 15, (opener, small, large)


def test_first_opener_decides_what_is_hidden(spark):
    page = "a<script>'<!--'</script>b<!-- <script> -->c<!-->d<!--->e<style>x</style >f<!-- open <p>g"
    df = spark.createDataFrame([(page,)], "h string")
    assert one(df, html.without_hidden_markup("h")) == "abcdef"
