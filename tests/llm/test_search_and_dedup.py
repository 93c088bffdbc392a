"""N-gram join, suffix dedup, top-k, NN-descent and the pipeline against brute force."""

import random
import re

import numpy as np
import pytest

import corpus_pipeline
from quire.llm import common, components, ngram_join, nn_descent, stages, suffix_dedup, topk


def _words(rng, n, kinds=5000):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


def _near_texts():
    rng, out = random.Random(3), []
    base = _words(rng, 300)
    for _ in range(40):  # near copies around the threshold, with differing distances
        w = list(base)
        for _ in range(rng.randrange(1, 14)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    passage = " ".join(_words(rng, 60))
    out += [" ".join(_words(rng, 60)) + " " + passage + "\n" + " ".join(_words(rng, 60)) for _ in range(45)]
    out += [None, "", "  \t", "one two", "ONE  two", "one two three", "one two three", base[0], " ".join(base).upper(), "a b c d", "a b c d a b c d"]
    return out


def _brute_components(texts):
    sets = {}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k:k + 4]) for k in range(len(w) - 3)} or ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    for i in sets:
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * n >= 85 * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = {k: a if v == b else v for k, v in label.items()}
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("piece,frequent", [(256, 32), (4, 3)])
def test_ngram_join(spark, piece, frequent):
    texts = _near_texts()
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)] + [(None, "one two", "c")],
                                 "doc_id long, text string, component string").repartition(5)
    got = ngram_join.join_similar(docs, piece=piece, at_once=7, frequent=frequent, bits=12).collect()
    assert len(got) == len(texts) + 1
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == _brute_components(texts)
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_ngram_join_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.join_similar(docs, bits=12).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def _brute_repeats(texts, length):
    seen = {}
    for t in texts:
        for k in range(len(t) - length + 1):
            seen[t[k:k + length]] = seen.get(t[k:k + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("hot,merged", [(100_000, 20_000), (2, 5)])
def test_suffix_dedup(spark, hot, merged):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    passage, other = text(300), text(150)
    texts = [text(rng.randrange(0, 300)) + passage[rng.randrange(120):300 - rng.randrange(120)] + text(rng.randrange(0, 200)) for _ in range(40)]
    texts += [other + text(50) + other, "ab" * 300, "x" * 500, text(99), "", other[:100] + text(10), texts[0], texts[0] + "tail"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, passage), (None, None)]
    docs = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, k1 string").repartition(6)
    got = sorted((r.row.doc_id is None, r.row.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in
                 suffix_dedup.remove_repeats(docs, length=100, hot=hot, merged=merged).collect())
    want = sorted((d is None, d or 0, *w) for (d, _), w in zip(rows, _brute_repeats([(t or "").encode() for _, t in rows], 100), strict=True))
    assert got == want
    assert suffix_dedup.remove_repeats(docs.filter("false")).count() == 0


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(1)
    values = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    runs = []
    for k in range(7):
        own = sorted(values[k::7])
        shared, rests = suffix_dedup.front_code(own)
        runs.append(suffix_dedup.Run(shared, rests, own))
    merged = list(suffix_dedup.merge_runs(runs))
    assert [v for v, _, _ in merged] == sorted(values) and all(v == item for v, _, item in merged)
    for (a, _, _), (b, shared, _) in zip(merged, merged[1:], strict=False):
        assert shared == suffix_dedup.common_prefix(a, b, 0)


def _vectors(spark, n=600, d=8):
    rng = np.random.default_rng(2)
    m = (rng.standard_normal((6, d))[rng.integers(0, 6, n)] + 0.3 * rng.standard_normal((n, d))).astype(np.float32)
    m[100:250] = m[100]  # one very common vector
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    odd = [(900, None), (901, [1.0, None] + [0.0] * 6), (902, [float("nan")] * d), (903, [float("inf")] * d), (904, []), (None, rows[3][1]),
           (1000, [0.0] * d), (1100, [1.0, 2.0])]
    return rows, spark.createDataFrame([(*r, 0) for r in rows + odd + rows[:2]], "vec_id long, embedding array<float>, block int").repartition(4)


def test_topk(spark):
    rows, given = _vectors(spark)
    got = {}
    for r in topk.search(given.filter("vec_id % 50 = 0"), given, 5, block_rows=100, lot=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids = np.array([i for i, _ in rows] + [1000])
    m = np.floor(256 * np.array([v for _, v in rows] + [[0.0] * 8]))
    for a, q in zip(ids, m, strict=True):
        if a % 50 == 0:
            s = m @ q
            best = [j for j in np.lexsort((ids, -s)) if ids[j] != a][:5]
            assert sorted(got[a]) == [(k + 1, ids[j], int(s[j])) for k, j in enumerate(best)]
    assert 1100 not in got  # no other vector of its length
    assert topk.search(given.filter("false"), given, 5).count() == 0


def test_nn_descent(spark):
    rows, given = _vectors(spark)
    got = {}
    for r in nn_descent.search(given.filter("vec_id % 100 = 0"), given, 10, block=64, beam=48, neighbours=12, reverse=8).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    hits = total = 0
    for a in range(0, 600, 100):
        d = np.sqrt(((m - m[a]) ** 2).sum(axis=1))
        best = [j for j in np.lexsort((ids, d)) if j != a][:10]
        assert [k for k, _, _ in sorted(got[a])] == list(range(1, 11))
        assert all(abs(d[v] - s) < 1e-12 for _, v, s in got[a])
        hits, total = hits + len({v for _, v, _ in got[a]} & set(best)), total + 10
    assert hits >= 0.9 * total
    assert 1000 not in got  # a zero vector takes no part
    assert nn_descent.search(given.filter("false"), given.filter("false"), 3).count() == 0


def _recall(got, m, k=10):
    by = {}
    for r in got.collect():
        by.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for a, found in by.items():
        d = ((m - m[a]) ** 2).sum(axis=1)
        d[a] = np.inf
        hits += len(found & set(np.argsort(d, kind="stable")[:k].tolist()))
    return hits / (k * len(by))


def _given(spark, m):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "vec_id long, embedding array<float>").repartition(4)


def test_nn_descent_with_one_very_large_vector(spark):
    m = np.random.default_rng(3).standard_normal((400, 8)).astype(np.float32).astype(np.float64)
    m[399] *= 2.0 ** 40
    given = _given(spark, m)
    got = nn_descent.search(given.filter("vec_id % 50 = 0"), given, 10, block=64, beam=48, neighbours=12, reverse=8)
    assert _recall(got, m) >= 0.9


def test_nn_descent_goes_on_until_edges_stay(spark):
    m = np.random.default_rng(4).standard_normal((2000, 8)).astype("<f4")
    nodes = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(m)], "id long, v binary").repartition(4)
    edges = nn_descent.build_graph(nodes, "<f4", neighbours=16, reverse=12, block=8, directions=2).collect()
    d = ((m[:, None].astype(float) - m[None]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1)[:, :10]
    found = {(e.node, e.near) for e in edges}
    assert sum((i, int(j)) in found for i, row in enumerate(near) for j in row) >= 0.8 * near.size


def test_nn_descent_blocks_are_bounded(spark, monkeypatch):
    rng = np.random.default_rng(5)
    m = rng.standard_normal((900, 8))
    m[:300] = 5 + 1e-4 * rng.standard_normal((300, 8))  # a third around one centre
    same = [(1000 + i, np.array([1.0] * 7 + [i * 1e-40], "<f4")) for i in range(200)]  # no direction tells them apart
    rows = [(i, v.astype("<f4").tobytes()) for i, v in [*enumerate(m), *same]]
    nodes = spark.createDataFrame(rows, "id long, v binary").repartition(4)
    monkeypatch.setattr(nn_descent, "DEEP", 3)
    cells = nn_descent._blocks(nodes, "<f4", len(rows), 2, 64).groupBy("way", "size", "slot").count().collect()
    assert max(r["count"] for r in cells) <= 64 and sum(r["count"] for r in cells) == 2 * len(rows)


def test_pipeline_stages_take_effect(spark, tmp_path):
    rng = random.Random(9)
    shared = " ".join(_words(rng, 120))
    texts = ["you idiot moron scum " * 6 + " ".join(_words(rng, 20)) if i % 4 == 0 else " ".join(_words(rng, 200)) for i in range(160)]
    texts[1] = texts[2]
    texts[5] += " " + shared
    texts[6] += " " + shared
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "z") for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long, score string")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_join", "suffix_dedup", "packing"]
    now, left = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, str(tmp_path)).collect(), docs.schema)
        left[name] = {r.doc_id: r for r in now.collect()}
    assert set(left["toxicity"]) == {i for i in range(160) if i % 4}
    assert set(left["ngram_join"]) == set(left["toxicity"]) - {2}
    assert shared[10:-10] not in left["suffix_dedup"][5].text and left["suffix_dedup"][5].n_chars == len(left["suffix_dedup"][5].text)
    assert left["suffix_dedup"][7].text == texts[7]
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(left["suffix_dedup"])


def test_similar_stage_takes_five_words_and_80_percent(spark):
    base = [f"w{i}" for i in range(200)]
    near = [f"n{i}" if i in (30, 70, 110, 150) else w for i, w in enumerate(base)]  # 176/216 of five words, 181/213 of four
    far = [f"n{i}" if i in (25, 60, 95, 130, 165) else w for i, w in enumerate(base)]  # 171/221 of five words
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate([base, near, far])], "doc_id long, text string")
    assert sorted(r.doc_id for r in stages.one_of_similar(spark, docs, "").collect()) == [0, 2]
    assert sorted(r.component_id for r in ngram_join.join_similar(docs).collect()) == [0, 1, 2]


def test_similar_stage_keeps_one_row_of_each_group(spark):
    rng = random.Random(4)
    text = [" ".join(_words(rng, 150)) for _ in range(7)]  # more than 400 bytes each
    assert min(map(len, text)) > 400
    rows = [(1, text[0]), (2, text[1]), (2, text[1]), (2, text[1]),  # a repeated row
            (None, text[2]), (None, text[2]), (None, text[3]), (None, text[0]),  # null ids: repeated, alone, like another
            (5, text[4]), (5, text[0]), (6, text[4]), (6, text[5]), (9, text[5]),  # two texts under one id
            (7, ""), (7, ""), (8, ""), (8, None), (None, " "), (None, " ")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, key int").repartition(5)
    kept = stages.one_of_similar(spark, docs, "")
    assert kept.columns == docs.columns
    want = [(1, text[0]), (2, text[1]), (None, text[2]), (None, text[3]), (5, text[4]), (6, text[5]), (7, ""), (8, ""), (8, None), (None, " ")]
    assert sorted(map(repr, [(r.doc_id, r.text) for r in kept.collect()])) == sorted(map(repr, want))
    whole = stages.without_repeats(spark, kept, "").collect()
    assert sorted(map(repr, [(r.doc_id, r.text or "") for r in whole])) == sorted(map(repr, [(i, t or "") for i, t in want]))
    assert stages.one_of_similar(spark, docs.filter("false"), "").count() == 0


def test_word_hashes_by_blocks_equal_hashes_of_the_whole():
    data = np.frombuffer(b"one two " * 9 + b"x" * 50 + b" end", np.uint8)
    starts, ends, _ = common.spans(data != 32, np.array([0, len(data)]))
    for block in (1, 7, 40, 1 << 18):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(common, "HASH_BYTES", block)
            assert (common.word_hashes(data, starts, ends) == common.span_hashes(data, starts, ends)).all()
    assert not len(common.word_hashes(data[:0], starts[:0], ends[:0]))


def test_deep_walks_score_the_block_together():
    rng = np.random.default_rng(3)
    flat = np.floor(256 * rng.normal(size=(3000, 32))).astype("<i8")  # no bound stops a walk
    peaked = np.zeros((3000, 32), "<i8")
    peaked[np.arange(3000), rng.integers(0, 32, 3000)] = rng.integers(-99, 99, 3000)
    for rows, deep in ((flat, True), (peaked, False)):
        for scale in (1, 1 << 45):  # beyond 53 bits in Python integers
            lists = topk.SortedLists(rows * scale)
            asked = [*(rows[::300] * scale), np.zeros(32, "<i8")]
            walked = []
            lists._walk = lambda *a, w=type(lists)._walk, to=walked, at=lists: to.append(w(at, *a)) or to[-1]
            for q, (who, scores) in zip(asked, lists.best_of(asked, 6), strict=True):
                s = (rows * scale).astype(object) @ q.astype(object)
                want = np.flatnonzero(s >= np.sort(s)[-6])
                assert sorted(zip(who.tolist(), map(int, scores), strict=True)) == [(i, int(s[i])) for i in want]
            assert sum(w is None for w in walked) == (len(asked) - 1 if deep else 0)


def test_pipeline_cuts_repeated_passages_of_50_words(spark):
    """Shorter than the 400 bytes of op2, which keeps them."""
    rng = random.Random(12)
    passage = " ".join(_words(rng, 60))[:330].strip()
    assert len(passage.split()) > 50 and 250 < len(passage.encode()) < 400, (len(passage.split()), len(passage))
    texts = [" ".join(_words(rng, 120)) for _ in range(6)]
    whole = list(texts)
    for i in (1, 3, 4):
        texts[i] = f"{texts[i][:200]} {passage} {texts[i][200:]}"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r.doc_id: r.text for r in stages.without_repeats(spark, docs, "").collect()}
    for i in range(6):
        assert passage[10:-10] not in left[i] and len(left[i]) >= len(whole[i]) - 4
        assert i in (1, 3, 4) or left[i] == texts[i]
    assert all(r.n_removed == 0 for r in suffix_dedup.remove_repeats(docs).collect())
