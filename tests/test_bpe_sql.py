import random
from collections import Counter

import regex

from quire.functions.sql import register_sql_functions
from quire.operators import bpe
from tests.conftest import SF_SMALL

GPT2 = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _reference(texts, rounds):
    bc = bpe.byte_chars()
    wc = Counter(w for t in texts for w in GPT2.findall(t))
    words = {w: [bc[b] for b in w.encode()] for w in wc}
    merges = []
    for _ in range(rounds):
        pc = Counter()
        for w, s in words.items():
            for a, b in zip(s, s[1:]):
                pc[(a, b)] += wc[w]
        if not pc:
            break
        best = sorted(pc.items(), key=lambda kv: (-kv[1], kv[0]))[0][0]
        merges.append(best)
        for w, s in words.items():
            o = []
            for x in s:
                if o and o[-1] == best[0] and x == best[1]:
                    o[-1] = best[0] + best[1]
                else:
                    o.append(x)
            words[w] = o
    ids = {bc[b]: b + 1 for b in range(256)}
    ids.update({a + b: 257 + i for i, (a, b) in enumerate(merges)})
    enc = [[ids[s] for w in GPT2.findall(t) for s in words[w]] for t in texts]
    return merges, enc


def test_byte_chars_rule():
    bc = bpe.byte_chars()
    assert len(set(bc)) == 256 and bc[ord("A")] == "A" and bc[ord(" ")] == "Ġ"


def test_bpe_equals_sequential_reference(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(8)
    rows = docs.collect()
    merges = bpe.fit_bpe(docs, "text", 6, cut_every=3)
    ref_merges, ref_enc = _reference([r.text for r in rows], 6)
    assert merges == ref_merges
    got = {r.doc_id: r.ids for r in bpe.bpe_encode(docs, merges, ["doc_id"]).collect()}
    assert [got[r.doc_id] for r in rows] == ref_enc


def test_chunk_ids_udtf(spark):
    register_sql_functions(spark)
    out = spark.sql("SELECT * FROM chunk_ids(array(1,2,3,4,5,6,7), 3)").collect()
    assert [(r.chunk_idx, r.start, r.input_ids) for r in out] == [(0, 0, [1, 2, 3]), (1, 3, [4, 5, 6])]
    none = spark.sql("""SELECT count(*) AS n FROM VALUES (array(1), 2), (array(1), 0), (CAST(NULL AS ARRAY<INT>), 2), (array(1), CAST(NULL AS INT))
                        AS t(ids, len), LATERAL chunk_ids(t.ids, t.len) c""")
    assert none.first().n == 0
    plan = spark.sql("SELECT c.* FROM VALUES (array(1, 2, 3)) AS t(ids), LATERAL chunk_ids(t.ids, 2) c")
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_many_merges_and_ties_equal_sequential_reference(spark, monkeypatch):
    """Few letters, runs of one letter and many equal counts: rounds of several merges keep the order of a fit merge by merge."""
    rnd = random.Random(2)
    texts = [" ".join("".join(rnd.choice("aab c") for _ in range(rnd.randint(1, 12))) for _ in range(30)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts + ["é" * 9, "aaaaaaa aaaa", ""])), "doc_id long, text string")
    texts = [r.text for r in docs.collect()]
    ref, ref_enc = _reference(texts, 40)
    for candidates, cut in ((4096, 3), (5, 16)):
        monkeypatch.setattr(bpe, "CANDIDATES", candidates)
        assert bpe.fit_bpe(docs, "text", 40, cut_every=cut) == ref
    got = {r.doc_id: r.ids for r in bpe.bpe_encode(docs, ref, hot_size=3).collect()}
    assert [got[i] for i in range(len(texts))] == ref_enc


def test_next_merges_are_the_sequential_ones():
    """Every run that ``next_merges`` gives, at any cut of the candidate list, against one merge at a time."""
    rnd = random.Random(7)
    for _ in range(60):
        words = [(["a", "b", "c", "d"][:rnd.randint(2, 4)], rnd.randint(1, 3)) for _ in range(8)]
        words = [([rnd.choice(letters) for _ in range(rnd.randint(2, 7))], n) for letters, n in words]
        for keep in (2, 4, 100):
            state = [(list(s), n) for s, n in words]
            pairs = _pair_counts(state)
            run = bpe.next_merges([(n, *p) for p, n in pairs][:keep], 0 if len(pairs) <= keep else pairs[keep][1])
            for p in run:
                assert _pair_counts(state)[0][0] == p
                state = [(_merged(s, p), n) for s, n in state]


def _pair_counts(state):
    pc = Counter()
    for s, n in state:
        for p in zip(s, s[1:]):
            pc[p] += n
    return sorted(pc.items(), key=lambda kv: (-kv[1], kv[0]))


def _merged(s, p):
    o, i = [], 0
    while i < len(s):
        if tuple(s[i:i + 2]) == p:
            o.append(s[i] + s[i + 1])
            i += 2
        else:
            o.append(s[i])
            i += 1
    return o
