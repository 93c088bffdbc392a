"""The trie against a brute-force one, running sums against a fold."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quire.llm import conversation_trie
from quire.llm.common import prepare
from quire.llm.running import running


def _brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            md5 = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, md5, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        full[c] = (*own.get(base, [])[:h], *turns[h:])
    members = defaultdict(list)
    for c, t in full.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    total = {}
    for p in sorted(members, key=len, reverse=True):
        leaves = sum(total[k][0] for k in children[p]) or 1
        saved = sum(total[k][1] for k in children[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        total[p] = (leaves, saved)
    return {(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *total[p],
             hashlib.sha256(",".join(str(c) for c in sorted(m) if full[c] == p).encode()).hexdigest()) for p, m in members.items()}


def _rows(seed):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(-12, 60), 10**12, 10**12 + 1]:
        # few texts, so that prefixes are shared at every depth; some conversations are short, one is long
        n = 60 if c in (20, 21) else rnd.randint(1, 7)
        for t in range(n):
            rows.append((c, None if rnd.random() < 0.1 else t, rnd.choice(["user", "assistant", None]) if rnd.random() < 0.1 else "user",
                         rnd.choice(["a", "é" * 3, None, ""] if t > 2 else ["same", "other"]) if c not in (20, 21) else f"t{t}"))
    return rows + [(None, 1, "user", "no conversation"), (3, 2, "user", "tie"), (3, 2, "user", "tie"), (3, 2, "user", "tie b")]


@pytest.mark.parametrize("sketch_rows,cells,busy,lot", [(1 << 23, 4, 10_000, 1 << 16), (40, 1, 3, 8)])
def test_trie_equals_brute_force(spark, monkeypatch, sketch_rows, cells, busy, lot):
    prepare(spark)
    for name, v in (("SKETCH_ROWS", sketch_rows), ("CELLS_EACH", cells), ("BUSY", busy), ("LOT", lot)):
        monkeypatch.setattr(conversation_trie, name, v)
    rows = _rows(3)
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(5)
    out = conversation_trie.build(turns)
    got = [tuple(r) for r in out.collect()]
    want = _brute(rows)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert len(got) == len(want) and set(got) == want


def test_turnless_and_empty(spark):
    prepare(spark)
    # conversations of fewer turns than they lose, without a base: only the root
    lone = [c for c in range(100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:3]
    rows = [(c, 0, "user", "x") for c in lone]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {tuple(r) for r in conversation_trie.build(turns).collect()} == _brute(rows)
    assert conversation_trie.build(turns.filter("false")).collect() == []


def test_screen_never_keeps_a_shared_prefix(spark):
    prepare(spark)
    rows = spark.range(3000).select("id", F.lit(2).alias("d"), (F.col("id") % 2500 * 7919).alias("a"), (F.col("id") % 2500 * 104729).alias("b"),
                                    F.lit(0).cast("long").alias("pa"), F.lit(0).cast("long").alias("pb"))
    bits = spark.sparkContext.broadcast(conversation_trie.sketch(rows.repartition(6), 1 << 14))
    got = conversation_trie.screen(rows, bits).filter("own").collect()
    assert all(500 <= r.id < 2500 for r in got) and len(got) > 1800


def test_running_sums_over_partitions(spark):
    prepare(spark)
    rnd = random.Random(1)
    rows = [(rnd.choice([1, 1, 1, 2, 9]), i, rnd.randint(0, (1 << 61) - 1)) for i in range(4000)]
    got = running(spark.createDataFrame(rows, "k long, o long, v long").repartition(4), "k", ["o"], ["v"], "run").collect()
    want, sums = {}, defaultdict(int)
    for k, o, v in sorted(rows):
        sums[k] = (sums[k] + v) % (1 << 61)
        want[k, o] = sums[k]
    assert {(r.k, r.o): r.v for r in got} == want and len(got) == len(rows)
