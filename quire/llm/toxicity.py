"""Toxicity (operator 5): gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text, from its bytes alone: densities of a fixed lexicon
and of words and word beginnings that the labelled rows show to be toxic, their
proximity to second-person words, capitals, punctuation and obfuscation rates.
Trees and calibration are Spark ML models.  They are fitted on at most
``FIT_ROWS`` labelled rows that are not held out (a hash sample of them; the
bound is a parameter); every document is scored, whole.

Defined results: a null text counts as empty and is scored like one; a null id
is held out; repeated rows are scored each; several labels of one document
count as toxic if one is; rows without a label are only scored; without
labelled rows of both classes the score follows the fixed lexicon; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from quire.llm.common import lower_ascii, slices, span_hashes, spans, text_buffer, word_hashes
from quire.operators.indexing import write_table

FIT_ROWS, STEMS, MIN_Z, MIN_ODDS = 20_000, 2_000, 3.0, 1.5
TREES, DEPTH, NEAR, FOLDS = 20, 4, 5, 3
PREFIXES = (4, 5, 6)

#: Insults and abuse in four languages, lower case.
INSULTS = (
    "idiot idiots idiotic moron morons moronic stupid stupidity dumb dumbass imbecile cretin loser losers scum "
    "trash garbage worthless pathetic disgusting clown clowns fool fools jerk bastard bitch asshole shit crap "
    "fuck fucking bullshit damn hate kill die ugly filthy vermin pig retard trotteltrottel trottel dumm dummkopf "
    "idiotisch arschloch scheisse scheiße abschaum wertlos widerlich ekelhaft idiote imbécile crétin connard "
    "merde salaud stupide débile pourri dégoûtant minable idiota imbécil estúpido estúpida basura asqueroso "
    "patético mierda cabrón inútil payaso perdedor").split()
#: Words that address the reader.
SECOND_PERSON = ("you your yours yourself u ur du dich dir dein deine ihr euch euer sie ihnen tu te toi ton ta tes "
                 "vous votre vos tú ti usted ustedes vosotros vuestro").split()
#: What look-alike signs stand for.
LOOKS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "u", "|": "l"}

FEATURES = ["fixed_rate", "fixed_log", "stem_rate", "stem_log", "stem_max", "stem_sum", "near_rate", "near_log",
            "capital_rate", "shout_rate", "mark_rate", "exclaim_rate", "sign_rate", "mixed_rate", "disguise_log",
            "single_rate", "words_log"]


def _hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    return np.sort(span_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends))


class Lookup:
    """Values of 64-bit keys: a small prefilter, then binary search."""

    def __init__(self, keys, values=None):
        keys = np.asarray(keys, np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = np.ones(len(keys)) if values is None else np.asarray(values, float)[order]
        self.some = np.zeros(1 << 16, bool)
        self.some[(self.keys >> np.uint64(48)).astype(np.int64)] = True

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h))
        maybe = np.flatnonzero(self.some[(h >> np.uint64(48)).astype(np.int64)])
        if len(self.keys) and len(maybe):
            at = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
            hit = self.keys[at] == h[maybe]
            out[maybe[hit]] = self.values[at[hit]]
        return out


_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True
_LOOK = np.arange(256, dtype=np.uint8)
for _a, _b in LOOKS.items():
    _LOOK[ord(_a)] = ord(_b)
_CHANGED = np.arange(256) != _LOOK
_SIGNS = np.zeros(256, bool)
_SIGNS[[ord(c) for c in "*#$%&@^~_|<>=+"]] = True
_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in "!?.,;:"]] = True


def stem_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray):
    """Arrays of keys for every word: the word itself, and its beginnings where it is longer."""
    yield np.arange(len(starts)), words
    for k in PREFIXES:
        at = np.flatnonzero(ends - starts > k)
        yield at, word_hashes(data, starts[at], starts[at] + k) ^ np.uint64(k)


def features(data: np.ndarray, off: np.ndarray, fixed: Lookup, person: Lookup, stems: Lookup) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    n = len(off) - 1
    out = np.zeros((n, len(FEATURES)))
    low = lower_ascii(data)
    starts, ends, doc = spans(_INSIDE[low], off)
    words = word_hashes(low, starts, ends)
    count = lambda which, w=None: np.bincount(which, w, minlength=n)[:n]
    sums = lambda flags: np.append(0, np.cumsum(flags))[off[1:]] - np.append(0, np.cumsum(flags))[off[:-1]]
    total = np.maximum(count(doc), 1)
    known = fixed(words)
    odds = np.zeros(len(words))
    for at, keys in stem_keys(low, starts, ends, words):
        odds[at] = np.maximum(odds[at], stems(keys))
    bad = (known > 0) | (odds > 0)
    # second-person proximity: a bad word within NEAR words of an address, in one text
    address = person(words) > 0
    near = np.zeros(len(words), bool)
    for k in range(1, NEAR + 1):
        same = doc[k:] == doc[:-k]
        near[k:] |= address[:-k] & same
        near[:-k] |= address[k:] & same
    near &= bad
    hits, learned, close = count(doc, known), count(doc, odds > 0), count(doc, near)
    out[:, 0], out[:, 1] = 100 * hits / total, np.log1p(hits)
    out[:, 2], out[:, 3] = 100 * learned / total, np.log1p(learned)
    np.maximum.at(out[:, 4], doc, odds)
    out[:, 5] = count(doc, odds) / np.sqrt(total)
    out[:, 6], out[:, 7] = 100 * close / total, np.log1p(close)
    chars = np.maximum(np.diff(off), 1)
    capital = (data - np.uint8(65)) < 26
    out[:, 8] = 100 * sums(capital) / chars
    caps = np.append(0, np.cumsum(capital))
    out[:, 9] = 100 * count(doc, (caps[ends] - caps[starts] == ends - starts) & (ends - starts > 2)) / total
    out[:, 10] = 100 * sums(_MARKS[data]) / chars
    out[:, 11] = 100 * sums(data == 33) / chars
    out[:, 12] = 100 * sums(_SIGNS[data]) / chars
    # obfuscation: words with look-alike signs, read as what they look like
    wide = _INSIDE[low] | _CHANGED[low]
    s2, e2, d2 = spans(wide, off)
    swapped, letter = np.append(0, np.cumsum(_CHANGED[low])), np.append(0, np.cumsum((low - np.uint8(97)) < 26))
    mixed = (swapped[e2] > swapped[s2]) & (letter[e2] > letter[s2])
    out[:, 13] = 100 * count(d2, mixed) / total
    at = np.flatnonzero(mixed)
    read = word_hashes(_LOOK[low], s2[at], e2[at])
    out[:, 14] = np.log1p(count(d2[at], (fixed(read) > 0) | (stems(read) > 0)))
    out[:, 15] = 100 * count(doc, ends - starts == 1) / total
    out[:, 16] = np.log1p(count(doc))
    return out


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def fit_rows(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """doc_id, text, toxic of at most about ``most`` labelled rows that are not held out."""
    own = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna()
           .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = own.count()
    if n > most:
        own = own.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(n)) < most)
    # at most ``most`` ids: a bounded broadcast
    return docs.select("doc_id", "text").join(F.broadcast(own), "doc_id")


def learn_stems(rows: DataFrame, most: int = STEMS) -> tuple[list, list]:
    """Keys and log odds of the words and beginnings that mark toxic rows (``most`` of them)."""

    def run(batches):
        for b in slices(batches, "text"):
            data, off = text_buffer(b.column("text"))
            low = lower_ascii(data)
            starts, ends, doc = spans(_INSIDE[low], off)
            words = word_hashes(low, starts, ends)
            found = [(keys, doc[at]) for at, keys in stem_keys(low, starts, ends, words)]
            keys, where = (np.concatenate(x) for x in zip(*found, strict=True))
            if not len(keys):
                continue
            order = np.lexsort((where, keys))
            keys, where = keys[order], where[order]
            once = np.append(True, (keys[1:] != keys[:-1]) | (where[1:] != where[:-1]))
            keys, bad = keys[once], b.column("toxic").to_numpy(zero_copy_only=False)[where[once]]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[first].view(np.int64)), pa.array(np.diff(np.append(first, len(keys)))),
                 pa.array(np.add.reduceat(bad, first).astype(np.int64))], names=["stem", "n", "bad"])

    counts = (rows.select("text", "toxic").mapInArrow(run, "stem long, n long, bad long")
              .groupBy("stem").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    total, bad = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    p1, p0 = (F.col("bad") + 0.5) / (bad + 1), (F.col("n") - F.col("bad") + 0.5) / (total - bad + 1)
    spread = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("n") - F.col("bad") + 0.5))
    best = (counts.withColumn("odds", F.log(p1 / p0)).withColumn("z", F.col("odds") / spread)
            .filter((F.col("z") >= MIN_Z) & (F.col("odds") >= MIN_ODDS)).orderBy(F.desc("z"), "stem").limit(most).collect())
    return [r["stem"] for r in best], [r["odds"] for r in best]


def with_features(docs: DataFrame, stems: tuple[list, list], keep: list[str]) -> DataFrame:
    """``keep`` and ``features`` (array of doubles) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(stems)
    schema = docs.select(*keep).schema.add("features", ArrayType(DoubleType()))

    def run(batches):
        keys, odds = shared.value
        parts = Lookup(_hashes(INSULTS)), Lookup(_hashes(SECOND_PERSON)), Lookup(np.array(keys, np.int64).view(np.uint64), odds)
        for b in slices(batches, "text"):
            f = features(*text_buffer(b.column("text")), *parts)
            rows = pa.ListArray.from_arrays(pa.array(np.arange(0, f.size + 1, f.shape[1]), pa.int32()), pa.array(f.ravel()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), rows], names=[*keep, "features"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


class ToxicityModel:
    """Stems, trees and calibration; ``score`` adds ``score`` (0 to 1)."""

    def __init__(self, stems, trees=None, curve=None):
        self.stems, self.trees, self.curve = stems, trees, curve

    def score(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        rows = with_features(docs, self.stems, keep)
        if self.trees is None:
            fixed = F.element_at("features", 1)
            return rows.select(*keep, (1 - F.exp(-fixed)).alias("score"))
        scored = self.curve.transform(_margins(self.trees, rows))
        # the curve has flat steps: a small share of the trees' own margin orders equal values
        return scored.select(*keep, (0.99 * F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0))
                                     + 0.01 / (1 + F.exp(-2 * F.col("margin")))).alias("score"))


def _margins(trees, rows: DataFrame) -> DataFrame:
    out = trees.transform(rows.withColumn("vector", array_to_vector("features")))
    return out.withColumn("margin", vector_to_array("raw")[1]).drop("vector", "raw", "tree_class", "tree_share")


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> ToxicityModel:
    rows = write_table(fit_rows(docs, labels, most), "toxicity-rows")
    total, bad = rows.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not bad or bad == total:
        return ToxicityModel(([], []))
    # the rows that the trees and the curve see get their features from stems of the other rows
    fold, own = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(FOLDS)), None
    for k in range(FOLDS):
        part = with_features(rows.filter(fold == k), learn_stems(rows.filter(fold != k)), ["doc_id", "toxic"])
        own = part if own is None else own.unionByName(part)
    stems = learn_stems(rows)
    # a quarter of the rows is kept from the trees, for calibration
    ready = write_table(own.select(
        F.col("toxic").cast("double").alias("label"), array_to_vector("features").alias("vector"), "features",
        (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0).alias("calibrates")), "toxicity-features")
    trees = GBTClassifier(featuresCol="vector", labelCol="label", predictionCol="tree_class",
                          maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=1)
    trees = trees.setRawPredictionCol("raw").setProbabilityCol("tree_share").fit(ready.filter("not calibrates"))
    left = ready.filter("calibrates")
    if left.select("label").distinct().count() < 2:
        left = ready
    curve = IsotonicRegression(featuresCol="margin", labelCol="label").fit(_margins(trees, left.drop("vector")))
    return ToxicityModel(stems, trees, curve)
