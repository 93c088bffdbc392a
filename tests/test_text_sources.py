from pyspark.sql import functions as F

from quire.functions.text import is_nonempty, ustrip
from quire.sources.corpus import nonempty_records, read_articles
from quire.sources.lines import lines_of, read_lines, repeat_lines, with_row_id, write_lines


def test_unicode_strip_matches_python(spark):
    vals = [" a ", "\ta\t", " a ", "a b", "", "  ", "\x1cx\x1f", "a\r\n", "　中　"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(ustrip("v")).collect()]
    assert got == [v.strip() for v in vals]


def test_record_rule(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, "x")], "id int, text string")
    assert sorted(r.id for r in nonempty_records(df).collect()) == [3, 4]
    assert df.where(is_nonempty("text")).count() == 2


def test_lines_split_strip(spark):
    df = spark.createDataFrame([(1, " a \r\n\r\nb\rc\n  \n d e ")], "doc_id long, text string")
    got = [(r.pos, r.text) for r in lines_of(df, ["doc_id"]).orderBy("pos").collect()]
    assert got == [(0, "a"), (2, "b"), (3, "c"), (5, "d e")]


def test_line_file_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, "one\ntwo"), (2, ""), (3, " three ")], "id int, text string")
    write_lines(df.orderBy("id").coalesce(1), str(tmp_path / "out"))
    got = sorted(r.value for r in read_lines(spark, str(tmp_path / "out")).collect())
    assert got == ["one two", "three"]


def test_repeated_lines_are_written_once_a_file(spark, tmp_path):
    """Above a columnar writer's dictionary (1 MB) each copy would be written whole."""
    lines = spark.range(0, 6000, 1, 1).selectExpr(
        "id AS pos", "concat_ws('', transform(sequence(1, 10), i -> md5(concat(id, '-', i)))) AS text").localCheckpoint()

    def written(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet"))

    out = repeat_lines(lines, 50, "pos", "text")
    # beside the ids (8 bytes a row), the copies' texts cost next to nothing
    assert written(out, "copies") - written(out.select("line_id"), "ids") < 1.3 * written(lines, "once")
    assert spark.read.parquet(f"{tmp_path}/copies").selectExpr("count(*)", "min(line_id)", "max(line_id)", "count(DISTINCT line_id)").first()[:] == (
        300_000, 0, 299_999, 300_000)


def test_repeat_lines_order(spark):
    lines = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos long, text string")
    out = repeat_lines(lines, 4, "pos", "text").orderBy("line_id").collect()
    assert [r.text for r in out] == ["a", "b", "c"] * 4
    assert [r.line_id for r in out] == list(range(12))


def test_row_id_dense(spark):
    df = spark.range(0, 1000, 7).withColumn("k", (F.col("id") * 7919) % 1009)
    got = with_row_id(df, ["k", "id"], "rid").orderBy("rid").collect()
    exp = sorted((r.k, r.id) for r in df.collect())
    assert [(r.k, r.id) for r in got] == exp
    assert [r.rid for r in got] == list(range(len(exp)))


def test_article_cap(spark):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    assert read_articles(df, "doc_id", 10).count() == 10
    assert read_articles(df, "doc_id", None).count() == 100
    assert read_articles(df, "doc_id", 5e4).count() == 100


def test_read_corpus_layout(spark, tmp_path):
    from quire.sources.corpus import read_corpus
    import pytest
    root = tmp_path / "hub"
    spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "id int, text string").write.parquet(
        str(root / "wiki" / "en" / "train"))
    assert read_corpus(spark, str(root), "wiki", "en", "train").count() == 1
    with pytest.raises(ValueError):
        read_corpus(spark, str(root), "wiki", None)


def test_encode_with_callable(spark):
    from quire.operators.tokenize import encode_with
    df = spark.createDataFrame([(1, "ab c")], "id int, text string")
    out = encode_with(df, lambda s: s.map(lambda t: [ord(c) for c in t])).first()
    assert out.ids == [97, 98, 32, 99]


def test_url_file_and_page_lookup(spark, tmp_path):
    from quire.sources.pages import lookup_pages, read_url_file, url_list
    (tmp_path / "u.txt").write_text("http://a/1\n\n  http://b/2 \nhttp://a/1\nhttp://c/3\n")
    urls = read_url_file(spark, str(tmp_path / "u.txt"))
    assert [r.url for r in urls.orderBy("seq").collect()] == ["http://a/1", "http://b/2", "http://a/1", "http://c/3"]
    assert [r.seq for r in urls.orderBy("seq").collect()] == [0, 1, 2, 3]
    pages = spark.createDataFrame([(10, "http://a/1", "<p>a</p>"), (11, "http://b/2", "<p>b</p>"),
                                   (12, "http://a/1", "<p>dup</p>")], "page_id long, url string, html string")
    got = sorted((r.seq, r.page_id) for r in lookup_pages(urls, pages).collect())
    assert got == [(0, 10), (1, 11), (2, 10), (3, None)]
    assert url_list(spark, ["x", "x"]).count() == 2
