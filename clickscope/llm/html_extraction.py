"""Main-text extraction with site style trees.

The pages of a host are merged by the paths of their elements (tag, id and
class of each from the body down).  Over a host's distinct pages each path has

* a presentation importance: the entropy of the child sequences that the
  element has on the pages (base: number of pages), and
* a content importance: 1 less the mean entropy, over the texts that occur at
  the path, of each text's spread over the pages.  A text on every page has
  entropy 1, a text on one page 0.

An element's composite importance weighs its own presentation against its
children (``(1 - g^l) * own + g^l * mean of children``, ``l`` children); a
branch goes when it and everything below it stays under ``threshold``.  Paths
seen on fewer than ``min_pages`` distinct pages prove nothing.

What markup declares is prior knowledge: navigation, footers, forms, scripts,
adverts, notices, comments (by tag, role, class or id words) have importance 0;
plain text flow inside ``article`` or ``main`` is in the tree as all else is,
with ``FLOW_PRIOR`` of the weight of its content importance given to 1.  There only
a whole block group without a text of its own (``GROUPS``: a section, a list, a
table) can go; headings, table cells, by-lines and paragraphs stay however often
they repeat, unless their group goes.  When a page declares such a main part, its text is the text inside; if all of it
repeats (one article under several addresses) it stays.

Pages are parsed tolerantly (unclosed and stray tags, comments, raw text), in
time and memory linear in the page at any depth: a path is known by a hash of
its parent's and its own label.

Defined cases: null or empty html gives an empty text; a null url is a host of
its own (``''``); equal pages of a host count once in its tree; repeated rows
get equal results; an empty table gives an empty result; other columns are
ignored; a page whose every branch is unimportant has an empty text.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.tables import bounded_batches
from clickscope.session import cut_lineage

GAMMA = 0.9
#: Weight of the prior importance 1 of plain flow in a declared main part.
FLOW_PRIOR = 0.3
MAP_ROWS = 100_000

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"""
                    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

# HTML's own element classes (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote body center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
                     "h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split())
CLOSES_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
               "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
SCOPE = frozenset("ul ol dl table article main section div body html".split())
# Elements whose content can be a repeated block of its own inside an article.
GROUPS = frozenset("section div ul ol dl table details figure blockquote center".split())
# What declares that an element is not the article.
NOISE_TAGS = frozenset("nav footer aside form button select textarea script style noscript template iframe svg object canvas dialog menu "
                       "datalist fieldset audio video head title search optgroup option map applet frameset".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form tooltip".split())
NOISE_WORDS = frozenset("ad ads advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors promo promos promoted "
                        "promotion banner banners cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal "
                        "overlay newsletter subscribe subscription signup login paywall nav navbar navigation menu menus breadcrumb breadcrumbs "
                        "pagination pager sidebar sidebars aside widget widgets related recommended recommendations share sharing social comment "
                        "comments commentlist disqus respond reply replies footer masthead topbar skip toolbar copyright disclaimer tagcloud".split())
PART_WORDS = frozenset("comment comments reply replies ad ads advert sponsored promo related".split())


class Page:
    """Elements and text blocks of one page.

    ``parent, tag, label, noise, plain, main`` per element (0: the root) and
    ``blocks`` as ``(element, text)`` in page order."""

    def __init__(self, source: str):
        self.parent, self.tag, self.label = [-1], [""], [""]
        self.noise, self.plain, self.landmark, self.within = [False], [False], [False], [False]
        self.children: list[list[int]] = [[]]
        self.blocks: list[tuple[int, str]] = []
        self._stack = [0]
        self._open: Counter[str] = Counter()           # open elements by tag
        self._text: list[str] = []
        self._read(source)
        self._flush()
        self._settle()

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            self._text = []
            if text:
                owner = next((e for e in reversed(self._stack) if self.tag[e] not in INLINE or self.noise[e]), 0)
                self.blocks.append((owner, text))

    def _pop_to(self, depth: int) -> None:
        self._open.subtract(self.tag[e] for e in self._stack[depth:])
        del self._stack[depth:]

    def _close(self, tags: tuple[str, ...], scope: frozenset[str]) -> None:
        """Implied end tags: the nearest open element of ``tags`` inside scope."""
        if not any(self._open[t] for t in tags):
            return
        for d in range(len(self._stack) - 1, 0, -1):
            tag = self.tag[self._stack[d]]
            if tag in tags:
                self._pop_to(d)
                return
            if tag in scope:
                return

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            m = _TOKEN.search(source, at)
            if m is None:
                self._add(source[at:])
                return
            if m.start() > at:
                self._add(source[at:m.start()])
            at = m.end()
            if m[1]:
                self._end(m[1].lower())
            elif m[2]:
                tag = m[2].lower()
                self._start(tag, m[3] or "")
                if tag in RAW and not (m[3] or "").rstrip().endswith("/"):
                    close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                    at = close.end() if close else n
                    self._end(tag)

    def _add(self, text: str) -> None:
        self._text.append(html.unescape(text) if "&" in text else text)

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._text.append("\n")
            return
        if tag not in INLINE:
            self._flush()
        if tag in CLOSES_P:
            self._close(("p",), SCOPE - {"p"})
        if tag in CLOSES_SAME:
            self._close(CLOSES_SAME[tag], SCOPE - frozenset(CLOSES_SAME[tag]))
        if tag in ("html", "body") and tag in self.tag:
            return
        if tag in VOID:
            return
        given = {}
        for k, v in _ATTR.findall(attributes):
            given.setdefault(k.lower(), v.strip("\"'"))
        names = f"{given.get('id', '')} {given.get('class', '')}".split()
        me = len(self.tag)
        self.parent.append(self._stack[-1])
        self.children.append([])
        self.children[self._stack[-1]].append(me)
        self.tag.append(tag)
        self.label.append(tag + "".join(sorted(f".{x}" for x in names)))
        self.plain.append(not names and "role" not in given)
        up = self._stack[-1]
        inside = self.landmark[up] or self.within[up]
        self.within.append(inside)
        self.noise.append(self._declared_noise(tag, given, names, inside))
        self.landmark.append((tag in ("article", "main") or given.get("role") in ("main", "article")) and not self.noise[me])
        self._stack.append(me)
        self._open[tag] += 1

    @staticmethod
    def _declared_noise(tag: str, given: dict[str, str], names: list[str], inside: bool) -> bool:
        if tag in NOISE_TAGS or given.get("role", "").lower() in NOISE_ROLES or (tag == "header" and not inside):
            return True
        if "hidden" in given or given.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", given.get("style", "")):
            return True
        if tag in ("html", "body", "main"):
            return False
        known = PART_WORDS if tag == "article" else NOISE_WORDS
        for name in names:
            words = [w.lower() for w in _NAME_WORDS.findall(name)]
            if words and words[0] in ("no", "has", "with", "without", "is"):
                continue
            if any(w in known for w in words) or (not inside and "header" in words and tag != "article"):
                return True
        return False

    def _end(self, tag: str) -> None:
        if tag == "br":
            self._text.append("\n")
            return
        if tag not in INLINE:
            self._flush()
        if not self._open[tag]:
            return
        for d in range(len(self._stack) - 1, 0, -1):
            here = self.tag[self._stack[d]]
            if here == tag:
                self._pop_to(d)
                return
            if tag in INLINE and here not in INLINE:
                return

    def _settle(self) -> None:
        """What holds the declared main part is not noise itself; noise holds
        for everything below it."""
        n = len(self.tag)
        shut, holds = [False] * n, [False] * n         # below a noise aside, footer or nav; above a main part
        for e in range(1, n):
            p = self.parent[e]
            shut[e] = shut[p] or (self.noise[p] and self.tag[p] in ("aside", "footer", "nav"))
        for e in range(n - 1, 0, -1):
            if (self.landmark[e] and not shut[e]) or holds[e]:
                holds[self.parent[e]] = True
        for e in range(1, n):
            self.noise[e] = self.noise[e] and not holds[e]
        for e in range(1, len(self.tag)):
            self.noise[e] = self.noise[e] or self.noise[self.parent[e]]
        inside = [False] * len(self.tag)               # in a main part that is no noise
        flow = [False] * len(self.tag)                 # and plain from there on
        for e in range(1, len(self.tag)):
            p = self.parent[e]
            inside[e] = not self.noise[e] and (self.landmark[e] or inside[p])
            flow[e] = inside[e] and (self.landmark[e] or (flow[p] and self.plain[e]))
        self.inside, self.flow = inside, flow
        if any(inside[e] for e, _ in self.blocks):
            self.blocks = [b for b in self.blocks if inside[b[0]]]
        else:
            self.blocks = [b for b in self.blocks if not self.noise[b[0]]]

    def with_above(self, elements: Iterator[int]) -> set[int]:
        """The elements and all those that hold them."""
        found: set[int] = set()
        for e in elements:
            while e > 0 and e not in found:
                found.add(e)
                e = self.parent[e]
        return found

    def paths(self) -> list[str]:
        """A name for the path of each element from the body down."""
        out = [""]
        for e in range(1, len(self.tag)):
            up = out[self.parent[e]]
            top = self.tag[e] in ("html", "body") or not up
            out.append(hashlib.blake2b((self.label[e] if top else f"{up}>{self.label[e]}").encode("utf-8", "replace"), digest_size=12).hexdigest())
        return out

    def text(self, importance: dict[str, tuple[float, float]] | None = None, threshold: float = 0.5) -> str:
        """Text of the blocks whose branch is important enough."""
        if not importance or not self.blocks:
            return " ".join(t for _, t in self.blocks)
        paths = self.paths()
        owns = {e for e, _ in self.blocks}
        score, low = [1.0] * len(self.tag), [False] * len(self.tag)
        for e in range(len(self.tag) - 1, -1, -1):
            own, content = importance.get(paths[e], (1.0, 1.0))
            if self.flow[e]:
                own, content = (FLOW_PRIOR + (1 - FLOW_PRIOR) * x for x in (own, content))
            kids = [c for c in self.children[e] if not self.noise[c]]
            below = [score[c] for c in kids] + ([content] if e in owns else [])
            if not below:
                score[e], low[e] = 0.0, True
                continue
            weight = GAMMA ** len(kids)
            score[e] = (1 - weight) * own + weight * sum(below) / len(below)
            low[e] = score[e] < threshold and all(low[c] for c in kids) and (e not in owns or content < threshold)
        gone = [False] * len(self.tag)
        for e in range(1, len(self.tag)):
            group = not self.flow[e] or (self.tag[e] in GROUPS and e not in owns)
            gone[e] = gone[self.parent[e]] or (low[e] and group)
        kept = [(e, t) for e, t in self.blocks if not gone[e] and (self.flow[e] or importance.get(paths[e], (1.0, 1.0))[1] >= threshold)]
        if not kept:
            kept = [b for b in self.blocks if self.flow[b[0]]]
        return " ".join(t for _, t in kept)


_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def style_rows(pages: DataFrame, html_col: str, url_col: str) -> DataFrame:
    """``host, page, path`` with ``style`` (child sequence of the element) and
    the hash of a ``text`` that it owns (null: it owns none)."""
    src = bounded_batches(pages).select(F.col(url_col).alias("url"), F.col(html_col).alias("html"), F.xxhash64(html_col).alias("page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = set()
            for url, source, page in zip(*(b.column(c).to_pylist() for c in ("url", "html", "page"))):
                doc, host = Page(source or ""), host_of(url)
                paths = doc.paths()
                texts: dict[int, set[str]] = {}
                for e, t in doc.blocks:
                    texts.setdefault(e, set()).add(t)
                for e in doc.with_above(texts) | (texts.keys() & {0}):
                    style = " ".join(doc.label[c] for c in doc.children[e])
                    rows.update((host, page, paths[e], style, t) for t in texts.get(e, {None}))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), *(pa.array(c, pa.string()) for c in cols[2:])], ["host", "page", "path", "style", "text"])

    out = src.mapInArrow(run, "host string, page long, path string, style string, text string")
    return out.select("host", "page", "path", F.xxhash64("style").alias("style"), F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("text"))


def importances(rows: DataFrame, min_pages: int) -> DataFrame:
    """``host, path, own, content`` of the paths on ``min_pages`` pages or more.

    With ``c`` pages per value and ``m`` pages, ``-sum p log p`` is
    ``log S - sum(c log c) / S``: sums that combine before the shuffle."""
    rows = rows.distinct()
    styles = rows.select("host", "path", "page", "style").distinct().groupBy("host", "path", "style").count()
    own = styles.groupBy("host", "path").agg(F.sum("count").alias("s"), F.sum(F.col("count") * F.log("count")).alias("l"))
    pages = rows.select("host", "path", "page").distinct().groupBy("host", "path").agg(F.count(F.lit(1)).alias("m"))
    texts = rows.where("text is not null").groupBy("host", "path", "text").agg(F.count(F.lit(1)).alias("c"))
    spread = texts.groupBy("host", "path").agg(F.avg(F.log("c")).alias("h"))
    out = pages.where(F.col("m") >= min_pages).join(own, ["host", "path"]).join(spread, ["host", "path"], "left")
    base = F.log("m")
    return out.select("host", "path", F.round((F.log("s") - F.col("l") / F.col("s")) / base, 9).alias("own"),
                      F.coalesce(F.round(1 - F.col("h") / base, 9), F.lit(1.0)).alias("content"))


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html", url_col: str = "url",
            threshold: float = 0.5, min_pages: int = 4, map_rows: int = MAP_ROWS) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` of every page."""
    rows = cut_lineage(style_rows(pages, html_col, url_col), "style")
    found = cut_lineage(importances(rows, min_pages), "importance")
    src = pages.select(*keep, F.col(html_col).alias("__html"), F.col(url_col).alias("__url"))
    from pyspark.sql.types import LongType, StringType, StructType
    schema = StructType([src.schema[c] for c in keep]).add("text", StringType()).add("n_chars", LongType())

    def batch(b: pa.RecordBatch, maps: Iterator[dict]) -> pa.RecordBatch:
        texts = [Page(h or "").text(m, threshold) if h else "" for h, m in zip(b.column("__html").to_pylist(), maps)]
        return pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.names)

    if found.count() <= map_rows:                      # counted: a bounded map goes to every task
        by_host: dict[str, dict[str, tuple[float, float]]] = {}
        for r in found.collect():
            by_host.setdefault(r["host"], {})[r["path"]] = (r["own"], r["content"])

        def with_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield batch(b, (by_host.get(host_of(u), {}) for u in b.column("__url").to_pylist()))

        return src.mapInArrow(with_map, schema)

    page_paths = rows.select("host", "page", "path").distinct().join(found, ["host", "path"])
    per_page = page_paths.groupBy("host", "page").agg(F.collect_list(F.struct("path", "own", "content")).alias("__tree"))
    lower = F.lower(F.regexp_extract(F.coalesce("__url", F.lit("")), _HOST.pattern, 1))
    joined = src.withColumn("__host", lower).withColumn("__page", F.xxhash64("__html")).join(
        per_page, (F.col("__host") == F.col("host")) & (F.col("__page") == F.col("page")), "left").select(*keep, "__html", "__tree")

    def with_tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch(b, ({x["path"]: (x["own"], x["content"]) for x in t or ()} for t in b.column("__tree").to_pylist()))

    return joined.mapInArrow(with_tree, schema)
