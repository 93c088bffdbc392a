from pyspark.sql import functions as F

from quire.functions.html import (ARTICLE_DROP, PLAIN_DROP, article_text, html_to_text,
                                  page_text)
from tests.conftest import SF_SMALL

A = dict(drop=ARTICLE_DROP, prefer_article=True)

CASES = [
    # (html, plain text, article-profile text)
    ("a<b>b</b>", "a b", "a b"),
    ("one<!-- c -->two", "one two", "one two"),
    ("<!DOCTYPE html><p>x</p>", "x", "x"),
    ("<html><head><title>T</title></head></html>", "T", "T"),
    ('<script>var t="</p>";</script><p>k</p>', "k", "k"),
    ("<p>a<p>b", "a b", "a b"),
    ("</div>x", "x", "x"),
    ("<nav><article>in nav</article></nav><p>out</p>", "in nav out", "out"),
    ("<article><header>H</header>body</article>", "H body", "body"),
    ("<article>a<article>b</article>c</article>d", "a b c d", "a b c"),
    ("<article>one</article><article>two</article>", "one two", "one"),
    ("x &amp; y &amp z", "x & y & z", "x & y & z"),
    # whole names only; an unknown reference keeps its name, numbers below 256 are windows-1252
    ("a?x=1&notify=1 &notit; &not; &copyright;", "a?x=1&notify=1 &notit ¬ &copyright", "a?x=1&notify=1 &notit ¬ &copyright"),
    ("caf&eacute; &#233;&#xE9; &#150; &#129; &#x1F600; &#55555555; &#xD800;", "café éé – \x81 😀 � �", "café éé – \x81 😀 � �"),
    ("AT&T &; & x", "AT&T &; & x", "AT&T &; & x"),
    ("<p>&amp;lt; &amp;amp;</p>", "&lt; &amp;", "&lt; &amp;"),
    ("<ruby>kanji<rp>(</rp><rt>reading<b>x</b></rt><rp>)</rp></ruby> on", "kanji on", "kanji on"),
    ("<template><article>t</article></template><article>a</article>", "a", ""),
    ("<p>one<![CDATA[two & three]]>four</p>", "one two & three four", "one two & three four"),
    ("<article>a<nav><p>n</p></nav>b<nav>m</nav></article>", "a n b m", "a b"),
    ("<p>  line one\n  line two  </p>", "line one\n  line two", "line one\n  line two"),
    ("", "", ""),
    ("<footer>f</footer><aside>a</aside><p>p</p>", "f a p", "p"),
]


def test_golden_cases():
    for html, plain, art in CASES:
        assert html_to_text(html, PLAIN_DROP, False) == plain, html
        assert html_to_text(html, **A) == art, html
    assert html_to_text(None) is None


def test_udf_equals_function(spark):
    rows = [(i, c[0]) for i, c in enumerate(CASES)] + [(99, None)]
    got = spark.createDataFrame(rows, "id int, html string").select("id", page_text("html").alias("p"), article_text("html").alias("a"))
    for r in got.collect():
        assert (r.p, r.a) == ((None, None) if r.id == 99 else CASES[r.id][1:])


def test_udf_runs_once(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    df = pages.select(article_text("html").alias("t")).where(F.length("t") > 200)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_length_rule_is_strict(spark):
    rows = [(i, "x" * n) for i, n in enumerate((199, 200, 201))] + [(3, "😀" * 201), (4, "😀" * 200)]
    df = spark.createDataFrame(rows, "id int, text string")
    kept = sorted(r.id for r in df.where(F.length("text") > 200).collect())
    assert kept == [2, 3]
