"""Near words against all pairs, forms and roots on planted words."""

import random
import zlib
from collections import Counter
from itertools import combinations

import pytest

from quire.llm import spelling
from quire.llm.common import prepare


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def _words():
    rnd = random.Random(5)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randint(7, 9))) for _ in range(150)}
    # one first half shared by many, runs of one letter, letters beyond ASCII, a long word
    words |= {"abcdefgh" + "".join(rnd.choice("xyzé") for _ in range(rnd.randint(5, 8))) for _ in range(200)}
    words |= {"a" * n for n in range(7, 14)} | {"ÿ×÷Àéßñ", "ÿ×÷Àéßñé", "q" * 3000, "q" * 2999 + "r", "q" * 3001}
    return sorted(words)


@pytest.mark.parametrize("split", [1, 7, 10000])
def test_pairs_equal_all_pairs(spark, monkeypatch, split):
    prepare(spark)
    monkeypatch.setattr(spelling, "SPLIT", split)
    words = _words()
    got = spelling.near_pairs(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")).collect()
    want = {frozenset(p) for p in combinations(words, 2) if _one_edit(*p)}
    assert len(got) == len(want) and {frozenset((r.x, r.y)) for r in got} == want
    assert all(words[r.nx] == r.x and words[r.ny] == r.y for r in got)


def _typo(doc, run):
    run = run.translate({c: c + 32 for c in range(65, 91)})
    h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
    return run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]


def test_words_forms_and_roots(spark):
    prepare(spark)
    chain = {"wordone": 2, "wordonee": 25, "wordoneee": 260, "singular": 1, "ties" * 2: 2, "tiestiesa": 30, "tiestiesb": 30,
             "Àlpinism": 3, "short": 9}
    texts = [f"{w.upper() if i % 2 and w.isascii() else w}" for w, n in chain.items() for i in range(n)]
    rows = [(i // 2, " ".join(texts[j::40]), "x") for i, j in enumerate(range(40))] + [(None, "wordone-wordone", "y"), (5, None, "z"), (5, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    n = Counter(_typo(d, w) for d, t, _ in rows if t for w in t.replace("-", " ").split())
    n = {w: k for w, k in n.items() if k >= 2 and len(w) >= 7}
    got = {r.word: r for r in spelling.group_variants(docs).collect()}
    assert {w: r.n for w, r in got.items()} == n
    form = {}
    for w, k in n.items():
        near = sorted((-n[o], o) for o in n if _one_edit(w, o))
        assert got[w].n_near == len(near)
        form[w] = near[0][1] if near and -near[0][0] >= 10 * k else None
        assert got[w].form == form[w] and got[w].form_n == (n[form[w]] if form[w] else None)
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        assert got[w].root == root
    assert any(form.values())
    assert spelling.group_variants(docs.filter("false")).collect() == []
