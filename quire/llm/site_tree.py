"""HTML extraction (operator 6) with a site style tree.

Pages are scanned into blocks: runs of text with the path of block elements
(tag with class, id and role) above them.  The paths of all pages of a host,
merged, are its style tree.  Every node holds, over the host's distinct pages, how
its content repeats (entropy of the blocks) and how its children vary (entropy of
the child sequences); a node whose better value is low is decoration and is cut from
each page, and with its last such node a whole branch.  Elements whose
meaning is given (``nav``, ``footer`` and the like) are cut whatever
their entropy, and ``article`` and ``main`` are content; these hold for hosts with
too few pages, too.  A form, or a class, id or role with a word such as ``ad``, is cut unless it
holds an ``article`` or ``main`` or, on a page without text in these, most of the page's text outside links; where the word is only a part of a name
(``article-header``), the tree overrules it, too.

Defined results: null or empty html has empty text; a null url's pages form one
host without a tree; truncated markup ends where the page ends; repeated pages
count once in the tree and are extracted each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import slices
from quire.llm.url_filter import host_of

#: Pages a node needs before its entropy counts, and the importance under which a branch goes.
MIN_PAGES, LOW = 8, 0.3

#: Elements that are no article text.
NOISE_TAGS = set("nav footer aside form script style noscript template iframe object svg canvas button select "
                 "textarea menu dialog head title".split())
#: Words in class, id or role that mark what is no article text.
NOISE_WORDS = set("ad ads advert adverts advertisement advertising banner sidebar sidenav menu nav navbar navigation "
                  "breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert popup "
                  "modal newsletter subscribe signup login search share sharing social related recommended promo "
                  "promotion sponsor sponsored comment comments disqus respond replies widget pagination pager toolbar "
                  "contentinfo complementary dialog form".split())
CONTENT_TAGS = {"article", "main"}
#: Elements inside a line, elements without an end, and elements whose content is raw.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
             "small span strike strong sub sup time tt u var".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe"}
#: An open element of the key ends where one of the values begins.
_ENDS_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
              "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
IMPLIED = {"p": _ENDS_P, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
           "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}}

# a quote opens a value only right after the sign of equality; one that is never closed is part of an unquoted value
_VALUE = r"(?>\"[^\"]*\"|'[^']*'|[^\s>]*)"
_ATTRS = rf"(?>[\s/]+|[^\s/>=]+(?>\s*=\s*{_VALUE})?|=)*+"
_TOKEN = re.compile(rf"<!--.*?(?:--!?>|\Z)|<([a-zA-Z][^\s/>]*)({_ATTRS})(?:>|\Z)"
                    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(rf"(?:^|\s)(class|id|role)\s*=\s*({_VALUE})", re.I)
_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[a-z]+")


#: How a block is marked: by nothing, by part of a name (the tree may overrule it), by a whole name, form or tag.
FREE, WEAK, NOISE = 0, 1, 2


def _label(tag: str, attrs: str) -> tuple[str, int]:
    """(name of the node in a path, how its class, id or role marks noise)."""
    marks = [v.strip("\"'").lower() for _, v in _ATTR.findall(attrs)] if attrs else []
    name = ".".join([tag, *(re.sub(r"[\s/]+", ".", m) for m in marks)])
    if tag in ("html", "body", *CONTENT_TAGS):
        return name, FREE
    if any(w in NOISE_WORDS for m in marks for w in m.split()):
        return name, NOISE
    return name, WEAK if any(w in NOISE_WORDS for m in marks for w in _PART.findall(m)) else FREE


def blocks(page: str) -> list[tuple[str, str, int]]:
    """(path, text, how noise is marked) of every block with text, in page order."""
    out: list[tuple[str, str, bool, list]] = []
    # tag, name, noise whatever it holds, and what a marked node holds: mark, characters outside links, article or main
    stack: list[tuple[str, str, bool, list | None]] = []
    parts: list[str] = []
    at = linked = plain = total = 0
    given = False  # text in article or main

    def flush():
        nonlocal plain, total, given
        if parts:
            text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                marked, fixed = [x[3] for x in stack if x[3]], any(x[2] for x in stack)
                out.append(("/".join(x[1] for x in stack), text, fixed, marked))
                if not fixed:
                    total += plain
                    given = given or any(x[0] in CONTENT_TAGS for x in stack)
                    for m in marked:
                        m[1] += plain
            plain = 0

    while True:
        m = _TOKEN.search(page, at)
        part = page[at:m.start() if m else len(page)]
        parts.append(part)
        if not linked:
            plain += len(part.strip())
        if m is None:
            break
        at = m.end()
        start, end = m[1], m[3]
        if start:
            tag, attrs = start.lower(), m[2] or ""
            if tag in RAW:
                close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else len(page)
                continue
            if tag == "br":
                parts.append(" ")
                continue
            name, mark = _label(tag, attrs)
            if tag in INLINE and not mark:
                linked = 1 if tag == "a" else linked
                continue
            flush()
            linked = 1 if tag == "a" else linked
            if tag in VOID:
                continue
            while stack and tag in IMPLIED.get(stack[-1][0], ()):
                stack.pop()
            inside = any(x[0] in CONTENT_TAGS for x in stack)
            fixed = tag in NOISE_TAGS and tag != "form" or tag == "header" and not inside
            if tag in CONTENT_TAGS and not any(x[2] for x in stack):
                for x in stack:
                    if x[3]:
                        x[3][2] = True
            if not attrs.endswith("/") or tag not in ("svg", "path"):
                mark = NOISE if tag == "form" else mark
                stack.append((tag, name, fixed, [mark, 0, False] if mark else None))
        elif end:
            tag = end.lower()
            if any(x[0] == tag for x in stack):
                flush()
                while stack.pop()[0] != tag:
                    pass
            elif tag not in INLINE:
                flush()
            linked = 0 if tag == "a" else linked
    flush()
    return [(path, text, NOISE if fixed else max((m[0] for m in marked if not m[2] and (given or 2 * m[1] <= total)), default=FREE))
            for path, text, fixed, marked in out]


def _parents(path: str) -> list[str]:
    parts = path.split("/")
    return ["/".join(parts[:k]) for k in range(1, len(parts) + 1)]


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def style_nodes(pages: DataFrame) -> DataFrame:
    """One row per node and feature of each page: host, path, kind (content, style, or weak: content of blocks that
    part of a name marks), feature, page_key."""

    def run(batches):
        for b in slices(batches, "html"):
            cols: list[list] = [[], [], [], [], []]
            for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                every = blocks(page or "")
                found, weak = ([(p, t) for p, t, noise in every if noise == k] for k in (FREE, WEAK))
                if not (found or weak) or not host:
                    continue
                key = _digest("\n".join(t for _, t in found or weak))
                rows, children = {(p, "content", _digest(t)) for p, t in found} | {(p, "weak", _digest(t)) for p, t in weak}, {}
                for p, _ in found:
                    chain = _parents(p)
                    for up, down in zip(chain, chain[1:], strict=False):
                        kids = children.setdefault(up, [])
                        if not kids or kids[-1] != down:
                            kids.append(down)
                rows |= {(p, "style", _digest(" ".join(kids))) for p, kids in children.items()}
                for p, kind, feature in rows:
                    for c, v in zip(cols, (host, p, kind, feature, key), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["host", "path", "kind", "feature", "page_key"])

    return pages.select("host", "html").mapInArrow(run, "host string, path string, kind string, feature long, page_key long")


def importance(nodes: DataFrame) -> DataFrame:
    """host, path, pages, importance (0: every page repeats it, 1: every page has its own).

    A feature that is in c of a node's m pages has the entropy log(c) / log(m); a node's
    own importance is 1 less the mean entropy over its features' occurrences."""
    per_feature = nodes.distinct().groupBy("host", "path", "kind", "feature").agg(F.count(F.lit(1)).alias("c"))
    sizes = nodes.select("host", "path", "kind", "page_key").distinct().groupBy("host", "path", "kind").agg(
        F.count(F.lit(1)).alias("m"))
    sums = per_feature.groupBy("host", "path", "kind").agg(
        F.sum(F.col("c") * F.log("c")).alias("weighed"), F.sum("c").alias("total"))
    own = sums.join(sizes, ["host", "path", "kind"]).withColumn(
        "own", F.when(F.col("m") > 1, 1 - F.col("weighed") / F.col("total") / F.log("m")).otherwise(1.0))
    return own.groupBy("host", "path").agg(F.max("m").alias("pages"), F.max("own").alias("importance"),
                                           F.max(F.col("kind") == "weak").alias("weak"))


def low_nodes(tree: DataFrame, min_pages: int = MIN_PAGES, low: float = LOW) -> DataFrame:
    """host, cut (nodes of low importance on enough pages, those in article and main excepted: a branch
    goes when all its nodes are among them), spared (nodes marked by part of a name whose importance is not low)."""
    inner = F.col("path").rlike(r"(^|/)(article|main)(\.|/|$)")
    enough = F.col("pages") >= min_pages
    poor = ~inner & enough & (F.col("importance") < low)
    spared = F.col("weak") & enough & (F.col("importance") >= low)
    return tree.filter(poor | spared).groupBy("host").agg(
        F.sort_array(F.collect_set(F.when(poor, F.col("path")))).alias("cut"),
        F.sort_array(F.collect_set(F.when(spared, F.col("path")))).alias("spared"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, low: float = LOW) -> DataFrame:
    """page_id, url, text (blocks of the page that are left, joined by one space)."""
    own = pages.select("page_id", "url", F.col("html").cast("string").alias("html")).withColumn("host", host_of(F.col("url")))
    cut = low_nodes(importance(style_nodes(own)), min_pages, low)

    def run(batches):
        for b in slices(batches, "html"):
            texts = []
            for page, gone, spared in zip(*(b.column(c).to_pylist() for c in ("html", "cut", "spared")), strict=True):
                gone, spared = set(gone or ()), set(spared or ())
                texts.append(" ".join(t for p, t, noise in blocks(page or "")
                                      if p not in gone and (not noise or noise == WEAK and p in spared)))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    schema = own.select("page_id", "url").schema.add("text", "string")
    return own.join(cut, "host", "left").select("page_id", "url", "html", "cut", "spared").mapInArrow(run, schema)
