"""URL filter (operator 10): a blocked Bloom filter of listed canonical URLs, an exact hash
join behind it, and host / path rules above both.

The filter is a table of at most ``MAX_BLOCKS`` rows (one 512-bit block each,
one bit per key in each of its eight words), so its broadcast has a fixed
bound; beyond the size where it is roomy it only lets more URLs through to the
exact join, which alone decides.

Defined results: a null URL, or one without ``://``, has empty host and path
and an empty canonical form, which is never listed; repeated rows stay; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS, MAX_BLOCKS, BITS_PER_KEY = 8, 1 << 15, 16
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rules (verdict, host, path); the longest fitting one wins.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Site names whose stored pages make up the derived list of blocked URLs.
LISTED_SITES = ["adult-x", "casino-win", "free-bets", "spam-farm"]


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def canonical(url: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without closing slashes; no scheme, query or fragment."""
    return F.concat(F.regexp_replace(host_of(url), r"^(www|m)\.", ""),
                    F.regexp_replace(path_of(url), r"/+$", ""))


def listed_urls(pages: DataFrame, sites: list[str] = LISTED_SITES) -> DataFrame:
    """The list, derived from the given pages: distinct canonical URLs on listed sites."""
    site = F.regexp_extract(host_of(F.col("url")), r"([^.]+)\.[^.]+\.[^.]+$", 1)
    return pages.filter(site.isin(sites)).select(canonical(F.col("url")).alias("canon")).distinct()


def _probe(canon: Column, blocks: int) -> tuple[Column, list[Column]]:
    h = F.xxhash64(canon)
    bits = F.xxhash64(canon, F.lit(1))
    return F.pmod(h, F.lit(blocks)), [
        F.call_function("shiftleft", F.lit(1).cast("long"),
                        F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        for i in range(WORDS)]


def bloom_blocks(listed: DataFrame, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """(filter table, number of blocks): columns ``block`` and the words ``w0`` to ``w7``."""
    n = listed.count()
    blocks = min(max_blocks, max(1, -(-n * BITS_PER_KEY // 512)))
    block, bits = _probe(F.col("canon"), blocks)
    aggs = [F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)]
    return (listed.select(block.alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(bits)])
            .groupBy("block").agg(*aggs)), blocks


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule string, its verdict) of the longest fitting rule, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES, id_col: str = "page_id",
               max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """id, url, host, path, rule, listed (boolean), verdict.  ``listed`` has one column ``canon``."""
    listed = listed.select("canon").filter(F.col("canon") != "").distinct()
    table, blocks = bloom_blocks(listed, max_blocks)
    urls = pages.select(F.col(id_col).alias("page_id"), "url")
    urls = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")),
                             "canon": canonical(F.col("url"))})
    block, bits = _probe(F.col("canon"), blocks)
    probed = urls.withColumn("block", block).join(F.broadcast(table), "block", "left")
    hit = F.lit(True)
    for i, b in enumerate(bits):
        hit = hit & (F.coalesce(F.col(f"w{i}"), F.lit(0)).bitwiseAND(b) != 0)
    probed = probed.withColumn("maybe", hit).drop("block", *[f"w{i}" for i in range(WORDS)])
    sure = probed.filter(~F.col("maybe")).withColumn("listed", F.lit(False))
    exact = probed.filter("maybe").join(listed.withColumn("listed", F.lit(True)), "canon", "left")
    both = sure.unionByName(exact.withColumn("listed", F.coalesce("listed", F.lit(False))))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return both.select("page_id", "url", "host", "path", rule.alias("rule"), "listed",
                       F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))
