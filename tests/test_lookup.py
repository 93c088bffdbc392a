"""In-row lookup: every size of the dictionary, hot unknown items, one plan."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import lookup as L
from quire.operators import skew, tokenize


def _plain(rows, table, default):
    return sorted((k, [table.get(x, default) for x in items] if items is not None else []) for k, items in rows)


@pytest.mark.parametrize("most,busy", [(None, 10_000), (0, 3), (2, 10_000), (4, 1)])
def test_values_at_every_dictionary_size(spark, monkeypatch, most, busy):
    monkeypatch.setattr(skew, "BUSY", busy)
    rnd = random.Random(3)
    table = {f"w{i}": i * 10 for i in range(9)}
    rows = [(i % 50, ["hot"] * (i % 3) + [rnd.choice(list(table) + ["no", None]) for _ in range(rnd.randint(0, 6))]) for i in range(120)]
    rows += [(7, None), (7, []), (7, ["w8"]), (7, ["w8"])]
    df = spark.createDataFrame(rows, "key long, items array<string>").repartition(5)
    entries = spark.createDataFrame([(w, v, r) for r, (w, v) in enumerate(table.items())], "t string, v int, rank long")
    got = L.lookup(df, "items", entries, "t", "v", "rank", "out", default=-1, most=most)
    assert got.columns == ["key", "out"]
    assert sorted((r.key, r.out) for r in got.collect()) == _plain(rows, table, -1)


def test_dictionary_is_bounded_in_bytes(spark, monkeypatch):
    entries = spark.createDataFrame([("x" * 100, i, i) for i in range(50)], "t string, v int, rank long")
    monkeypatch.setattr(L, "_BLOCK", 1)
    monkeypatch.setattr(L, "DICT_BYTES", 1300)
    assert L.dictionary_end(entries, "t", "v", "rank") == 1300 // (100 + 8 + 16)
    assert L.dictionary_end(entries, "t", "v", "rank", most=3) == 3
    assert L.dictionary_end(entries.where("false"), "t", "v", "rank") == 0


def test_fallback_gives_unknown_items_a_value(spark):
    entries = spark.createDataFrame([("a", [1], 0), ("b", [2], 1)], "t string, v array<int>, rank long")
    df = spark.createDataFrame([(1, ["a", "zz", "b", "q"])], "id int, items array<string>")
    own = lambda items: items.where("item <> 'q'").select("item", F.array(F.length("item")).alias("value"))
    out = L.lookup(df, "items", entries, "t", "v", "rank", "out", default=[0], fallback=own).first()
    assert out.out == [[1], [2], [2], [0]]


def _nodes(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [w for w in ("Exchange hashpartitioning", "SortMergeJoin", "BroadcastHashJoin", "Window", "Generate") if w in plan]


def test_one_plan_and_no_shuffled_text(spark, monkeypatch):
    """A hot unknown token, with a whole and a tiny dictionary: same result, same operators, no text in any exchange."""
    docs = spark.createDataFrame([(i, "seen here" if i % 3 else "unseen " * 50) for i in range(90)], "doc_id long, text string").repartition(4)
    vocab = tokenize.fit_vocab(spark.createDataFrame([("seen here now",)], "text string"))
    plans, results = [], []
    for size in (tokenize.HOT_VOCAB, 1):
        enc = tokenize.encode(docs, vocab, hot_size=size)
        results.append(sorted((r.doc_id, r.ids) for r in enc.collect()))
        plans.append(_nodes(enc))
        assert "text" not in enc._jdf.queryExecution().optimizedPlan().toString()
    assert results[0] == results[1] and plans[0] == plans[1]
    assert dict(results[0])[0] == [tokenize.UNK_ID] * 51  # the last blank is a pre-token of its own


def test_prefix_pieces(spark):
    vocab = tokenize.fit_vocab(spark.createDataFrame([("un do undo done x",), (" un un",)], "text string"))
    ids = {r.token: r.id for r in vocab.collect()}
    docs = spark.createDataFrame([(1, "undone"), (2, " undox?"), (3, "")], "doc_id long, text string")
    pieces = tokenize.prefix_pieces(vocab)
    got = {r.doc_id: r.ids for r in tokenize.encode(docs, vocab, fallback=pieces).collect()}
    # "un" only stands at the start of a text in the vocabulary, " undo" after a blank
    assert got[1] == [ids["un"]] + [tokenize.UNK_ID] * 4 and got[3] == []
    assert got[2] == [ids[" undo"]] + [tokenize.UNK_ID] * 2
    cut = {r.doc_id: r.ids for r in tokenize.encode(docs, vocab, fallback=pieces, max_tokens=1).collect()}
    assert cut[2] == [ids[" undo"]]


def test_prefix_pieces_come_from_the_whole_vocabulary(spark):
    """However few tokens a worker holds, every token of the vocabulary is a piece."""
    rnd = random.Random(5)
    words = {"".join(rnd.choices("ab\u00e9\U0001f600", k=rnd.randint(1, 6))) for _ in range(60)} | {"a" * 9, "a" * 7}
    ids = {w: i + tokenize.FIRST_ID for i, w in enumerate(sorted(words))}
    vocab = spark.createDataFrame([(w, i, 1) for w, i in ids.items()], "token string, id int, count long")
    texts = ["".join(rnd.choices("ab\u00e9\U0001f600x", k=rnd.randint(1, 14))) for _ in range(80)] + ["a" * 40]

    def plain(text):
        out = []
        while text:
            n = max((len(w) for w in ids if text.startswith(w)), default=0)
            out.append(ids.get(text[:n], tokenize.UNK_ID))
            text = text[max(n, 1):]
        return out

    items = spark.createDataFrame([(t,) for t in set(texts)], "item string")
    for size in (0, 5, tokenize.PIECES):
        got = {r["item"]: r["value"] for r in tokenize.prefix_pieces(vocab, size)(items).collect()}
        assert got == {t: plain(t) for t in set(texts)}
    assert tokenize.prefix_pieces(vocab.where("false"))(items.limit(1)).first().value[0] == tokenize.UNK_ID


def test_prefix_pieces_of_a_full_filter(spark, monkeypatch):
    """A filter that lets everything pass costs look-ups, not rows."""
    monkeypatch.setattr(tokenize, "PIECE_BITS", 64)
    vocab = spark.createDataFrame([(f"w{i}", i + 2, 1) for i in range(300)], "token string, id int, count long")
    items = spark.createDataFrame([("w299w1w",), ("w12x",)], "item string")
    got = {r["item"]: r["value"] for r in tokenize.prefix_pieces(vocab, 2)(items).collect()}
    assert got == {"w299w1w": [301, 3, tokenize.UNK_ID], "w12x": [14, tokenize.UNK_ID]}


def test_a_dictionary_made_before(spark, monkeypatch):
    """The same ids as with a dictionary of the call's own; a whole vocabulary needs no shuffle."""
    docs = spark.createDataFrame([(i, None if i == 3 else "seen here unseen " * (i % 4)) for i in range(20)], "doc_id long, text string").repartition(4)
    vocab = tokenize.fit_vocab(spark.createDataFrame([("seen here now",)], "text string"))
    want = sorted((r.doc_id, r.ids) for r in tokenize.encode(docs, vocab).collect())
    for size in (tokenize.HOT_VOCAB, 1):
        made = tokenize.dictionary(vocab, size)
        monkeypatch.setattr(L, "dictionary_end", None)
        enc = tokenize.encode(docs, vocab, made=made)
        monkeypatch.undo()
        assert made.whole == (size > 1) and ("Join" not in " ".join(_nodes(enc))) == made.whole
        assert sorted((r.doc_id, r.ids) for r in enc.collect()) == want


def test_few_rows_are_joined_at_once(spark, monkeypatch):
    left = spark.createDataFrame([("a", i) for i in range(6)] + [("b", 9), ("z", 0), (None, 1)], "k string, v int")
    right = spark.createDataFrame([("a", 1, 6), ("b", 2, 1), ("c", 3, 0)], "k string, w int, n long")
    want = sorted([("a", i, 1) for i in range(6)] + [("b", 9, 2)])
    few = skew.join_unique(left, right, "k")
    assert few._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    monkeypatch.setattr(skew, "BUSY", 2)
    many = skew.join_unique(left, right, "k")
    assert few.columns == many.columns == ["k", "v", "w"]
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) == want
