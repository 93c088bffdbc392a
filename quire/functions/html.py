"""Visible text of an HTML page.

Semantics (the behaviour being matched): the page is parsed into a tree; every
element in the drop set is removed with all it contains; optionally the first
remaining ``<article>`` is preferred over the whole page; the text nodes are
stripped one by one, empty ones dropped, and joined with one space.  Tags
separate words, entities do not; comments, the doctype and processing
instructions are not text.

Character references are resolved by their whole name (``&notify`` is no
``&not``); an unknown one stays as it is, without its semicolon.  Ruby annotations
(``rt``, ``rp``) and templates are no text of the page, CDATA sections are.

``page_text`` is an Arrow ``pandas_udf`` over the standard-library HTML tokenizer
(handles unclosed and nested tags); it shares nothing with ``quire.llm``.
"""

from __future__ import annotations

from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The two cleaning profiles and the elements that never hold content.
PLAIN_DROP = ("script", "style")
ARTICLE_DROP = ("script", "style", "header", "footer", "nav", "aside")
VOID_ELEMENTS = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link",
    "menuitem", "meta", "param", "source", "track", "wbr",
    "basefont", "bgsound", "command", "frame", "image", "isindex", "nextid", "spacer",
))
# Elements whose text is not the page's.
OTHER_TEXT = frozenset(("rt", "rp", "template"))
# Named entities that occur in crawled pages, as the SQL twin decodes
# them, with an optional semicolon ('&amp' last so '&amp;lt;' stays '&lt;').
REGEX_ENTITIES = (
    ("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;?", "\u00a0"), ("&middot;?", "·"), ("&copy;?", "©"),
    ("&reg;?", "®"), ("&amp;?", "&"),
)


def reference(name: str) -> str:
    """The text of the character reference ``&name;`` (or ``&name``)."""
    if not name.startswith("#"):
        return html5.get(name + ";", "&" + name)
    code = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
    if code < 256:  # numbers below 256 are often meant as windows-1252, which lacks five of them
        try:
            return bytes([code]).decode("windows-1252")
        except UnicodeDecodeError:
            return chr(code)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd"


class _TextCollector(HTMLParser):
    """Tag-stack walk equal to building the tree and reading its strings."""

    def __init__(self, drop: frozenset, prefer_article: bool):
        super().__init__(convert_charrefs=False)  # it would resolve the beginnings of longer names
        self.drop = drop
        self.prefer_article = prefer_article
        self.stack: list[tuple[str, bool, bool, bool]] = []   # (tag, dropped, in_article, other text)
        self.buf: list[str] = []
        self.page_nodes: list[str] = []
        self.article_nodes: list[str] = []
        self.article_seen = False

    def _flush(self):
        if not self.buf:
            return
        node = "".join(self.buf).strip()
        self.buf = []
        if not node:
            return
        if self.stack and (self.stack[-1][1] or self.stack[-1][3]):
            return
        self.page_nodes.append(node)
        if self.stack and self.stack[-1][2]:
            self.article_nodes.append(node)

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in VOID_ELEMENTS:
            return
        _, parent_dropped, in_article, other = self.stack[-1] if self.stack else ("", False, False, False)
        dropped = parent_dropped or tag in self.drop
        if (self.prefer_article and tag == "article" and not dropped
                and not self.article_seen):
            self.article_seen = True
            in_article = True
        self.stack.append((tag, dropped, in_article, other or tag in OTHER_TEXT))

    def handle_startendtag(self, tag, attrs):
        self._flush()

    def handle_endtag(self, tag):
        self._flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.buf.append(data)

    def handle_entityref(self, name):
        self.buf.append(reference(name))

    def handle_charref(self, name):
        self.buf.append(reference("#" + name))

    def handle_comment(self, data):
        self._flush()
        if data.startswith("[CDATA["):  # how some versions of the tokenizer hand it on
            self.unknown_decl(data[1:].removesuffix("]]"))

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()

    def unknown_decl(self, data):
        self._flush()
        if data[:6].upper() == "CDATA[":
            self.buf.append(data[6:])
            self._flush()

    def result(self) -> str:
        self.close()
        self._flush()
        nodes = self.article_nodes if self.article_seen else self.page_nodes
        return " ".join(nodes)


def html_to_text(html: str | None, drop=PLAIN_DROP, prefer_article: bool = False) -> str | None:
    """Plain-Python form of the rule, for one page (used by the UDF and by tests)."""
    if html is None:
        return None
    p = _TextCollector(frozenset(drop), prefer_article)
    p.feed(html)
    return p.result()


def _text_udf(drop: tuple, prefer_article: bool):
    drop = tuple(drop)

    @F.pandas_udf("string")
    def _page_text(html: pd.Series) -> pd.Series:
        return html.map(lambda h: html_to_text(h, drop, prefer_article), na_action="ignore")

    # Marked non-deterministic so a filter on the text is not pushed below the
    # projection, which would run the parser twice per page.
    return _page_text.asNondeterministic()


def page_text(col: Column | str, drop=PLAIN_DROP, prefer_article: bool = False) -> Column:
    """Visible text of the page in ``col`` (parser form, Arrow-batched Python)."""
    c = F.col(col) if isinstance(col, str) else col
    return _text_udf(tuple(drop), prefer_article)(c)


def article_text(col: Column | str, drop=ARTICLE_DROP) -> Column:
    """Text of the first ``<article>`` left after dropping, else of the page."""
    return page_text(col, drop=drop, prefer_article=True)
