"""Main text of web pages by a site style tree.

The trees of a host's pages are merged: elements with the same path of names are one node of
the host's tree. For each node the pages' presentations (the names of the child elements in
order) and contents (the digest of all text below) are counted, and their entropies give
the node's importance: a branch that looks and reads alike on many pages has none. Such branches
are removed from each page, next to those whose role says that they are no article. Counts
combine before they are shuffled and no host is gathered in one task.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custoria.llm.common import as_bytes, columns_of, rows_of
from custoria.session import materialize

#: Branches below this importance go; hosts with fewer different pages have no say.
IMPORTANCE, PAGES = 0.2, 3
#: Weight of the presentation's entropy next to the content's.
PRESENTATION = 0.3

# Fixed values of HTML: elements without an end, with raw text, that stand on lines of their own, that close an open sibling.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math canvas object select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
# Elements and names whose role is not the article.
OUTSIDE = frozenset("nav aside footer form head menu dialog button fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
NAMES = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside footer masthead topbar toolbar ad ads adv advert adverts advertisement "
    "advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup social share sharing related recommended recommendations comment comments commentlist disqus replies respond "
    "login search searchform pager pagination widget widgets copyright".split()
)
PROTECTED = frozenset({"article", "main"})

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?:^|[\s\"'])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?(?=[\s/\"']|$)", re.I)
WORDS = re.compile(r"[a-z0-9]+")


class Page:
    """A page's elements in document order, as parallel lists, and its text with the element that holds it."""

    def __init__(self, source: str):
        self.parent, self.tag, self.key, self.out, self.root = [-1], ["#page"], [0], [False], [False]
        self.kids: list[list[int]] = [[]]
        self.texts: list[tuple[int, str]] = []
        self._ordinals: list[dict[str, int]] = [{}]
        self._read(source)

    def _open(self, tag: str, attributes: str, parent: int) -> int:
        names, role, hidden = "", "", False
        if attributes:
            for name, value in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), entities.unescape(value.strip("\"'")).lower() if value else ""
                if name in ("class", "id"):
                    names += " " + value
                elif name == "role":
                    role = value
                elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                    hidden = True
        words = set(WORDS.findall(names))
        root = tag in PROTECTED or role in ("main", "article")
        outside = tag in OUTSIDE or role in ROLES or hidden or bool(words & NAMES) or (tag == "header" or "header" in words) and not self._inside(parent)
        if root and not words & NAMES and not hidden:
            outside = False
        name = f"{tag} {' '.join(sorted(words))}"
        ordinal = 0
        if tag not in ("p", "li", "tr", "td", "h1", "h2", "h3", "h4", "h5", "h6") and tag not in INLINE:
            ordinal = self._ordinals[parent][name] = self._ordinals[parent].get(name, 0) + 1
        me = len(self.tag)
        self.parent.append(parent)
        self.tag.append(tag)
        self.key.append(xxhash.xxh64_intdigest(f"{self.key[parent]}/{name}/{ordinal}"))
        self.out.append(outside)
        self.root.append(root and not outside)
        self.kids.append([])
        self._ordinals.append({})
        self.kids[parent].append(me)
        return me

    def _inside(self, element: int) -> bool:
        while element > 0:
            if self.root[element]:
                return True
            element = self.parent[element]
        return False

    def _read(self, source: str) -> None:
        at, now, tag, parent = 0, 0, self.tag, self.parent
        size = len(source)
        while at < size:
            found = TOKEN.search(source, at)
            end = found.start() if found else size
            if end > at:
                self.texts.append((now, entities.unescape(source[at:end])))
            if not found:
                break
            at = found.end()
            name = found[2]
            if not name:
                if found[0].startswith("<![CDATA["):
                    self.texts.append((now, found[0][9:].removesuffix("]]>")))
                continue
            name = name.lower()
            if found[1]:
                e = now
                while e > 0 and tag[e] != name:
                    e = parent[e]
                if e > 0:
                    if name not in INLINE:
                        self.texts.append((parent[e], " "))
                    now = parent[e]
                elif name in ("p", "br"):
                    self.texts.append((now, " "))
                continue
            if name in RAW:
                if not found[3].endswith("/"):
                    close = re.compile(f"</{name}\\s*>", re.I).search(source, at)
                    at = close.end() if close else size
                continue
            if name not in INLINE:
                self.texts.append((now, " "))
                # a paragraph ends where another block begins, and a cell or item where its sibling begins
                e, stop = now, SCOPES.get(name, ())
                closing = SIBLINGS.get(name)
                while e > 0 and (tag[e] in INLINE or tag[e] == "p" or closing and tag[e] in closing):
                    if tag[e] == "p" or closing and tag[e] in closing:
                        now = parent[e]
                    e = parent[e]
                    if tag[e] in stop:
                        break
            if name in VOID:
                continue
            element = self._open(name, found[3], now)
            if not found[3].endswith("/"):
                now = element
        del self._ordinals

    def dropped(self) -> list[bool]:
        """Elements that a role puts outside the article, with all below them; a branch that holds the article stays."""
        n = len(self.tag)
        holds = [False] * n
        for e in range(n - 1, 0, -1):
            if self.root[e] or holds[e]:
                holds[self.parent[e]] = True
        gone = [False] * n
        for e in range(1, n):
            gone[e] = gone[self.parent[e]] or self.out[e] and not (holds[e] and self.tag[e] not in OUTSIDE)
        return gone

    def roots(self, gone: list[bool]) -> list[bool]:
        """Elements inside an article that is not itself outside."""
        inside = [False] * len(self.tag)
        for e in range(1, len(inside)):
            inside[e] = not gone[e] and (inside[self.parent[e]] or self.root[e])
        return inside

    def nodes(self) -> list[tuple[int, int, int]]:
        """(key, presentation, content) of every element but inline ones; content is what stands below it."""
        n = len(self.tag)
        below: list[list[str]] = [[] for _ in range(n)]
        for e, text in self.texts:
            if text.strip():
                below[e].append(" ".join(text.split()))
        digests = [xxhash.xxh64() for _ in range(n)]
        for e in range(n - 1, 0, -1):
            for text in below[e]:
                digests[e].update(text + "\n")
            digests[self.parent[e]].update(digests[e].digest())
        return [
            (_signed(self.key[e]), _signed(xxhash.xxh64_intdigest(" ".join([self.tag[k] for k in self.kids[e]]))), _signed(digests[e].intdigest()))
            for e in range(1, n)
            if self.tag[e] not in INLINE
        ]

    def kept(self, unimportant: set[int]) -> tuple[list[bool], int]:
        """The elements whose text stays, and how many of the unimportant nodes went.

        The outermost article elements and those above them are protected, what stands below them is not. Where
        importance would remove all text, roles alone decide.
        """
        gone = self.dropped()
        inside = self.roots(gone)
        article = any(inside)
        plain = inside if article else [not x for x in gone]
        plain[0] = not article
        n = len(self.tag)
        protected = [False] * n
        for e in range(n - 1, 0, -1):
            if inside[e] and not inside[self.parent[e]]:
                protected[e] = True
            if protected[e]:
                protected[self.parent[e]] = True
        kept = list(plain)
        low = [False] * n
        for e in range(1, n):
            low[e] = not protected[e] and (low[self.parent[e]] or _signed(self.key[e]) in unimportant)
            kept[e] = plain[e] and not low[e]
        if not any(kept[e] and text.strip() for e, text in self.texts):
            kept = plain
        went = {self.key[e] for e in range(1, n) if not kept[e] and not protected[e] and _signed(self.key[e]) in unimportant}
        return kept, len(went)

    def text(self, unimportant: set[int]) -> str:
        """Text of the article, or, without one, of the page, less what role or importance removes."""
        return self.text_of(self.kept(unimportant)[0])

    def text_of(self, kept: list[bool]) -> str:
        pieces, last = [], True
        for e, text in self.texts:
            if kept[e]:
                pieces.append(text)
                last = True
            elif last:
                pieces.append(" ")
                last = False
        return " ".join("".join(pieces).split())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _page(data: bytes | None) -> Page:
    return Page((data or b"").decode("utf-8", "replace"))


def host_of(url):
    """The host of a URL column in lower case; an empty text where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _nodes(pages: DataFrame) -> DataFrame:
    """(host, key, node, presentation, content): the element name paths of each page, as arrays.

    Pages of equal host and key are one page, so that copies do not make their own text look alike.
    """
    fields = ("node", "presentation", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists: list[list[list[int]]] = [[], [], []]
            for data in as_bytes(batch.column(2)):
                merged: dict[int, list[int]] = {}
                for node, look, content in _page(data).nodes():
                    if node in merged:  # repeated names, such as paragraphs, are one node
                        was = merged[node]
                        was[0] = _signed(xxhash.xxh64_intdigest(f"{was[0]} {look}"))
                        was[1] = _signed(xxhash.xxh64_intdigest(f"{was[1]} {content}"))
                    else:
                        merged[node] = [look, content]
                for out, values in zip(lists, (list(merged), [b[0] for b in merged.values()], [b[1] for b in merged.values()])):
                    out.append(values)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(x, pa.list_(pa.int64())) for x in lists)], names=["host", "key", *fields])

    rows = pages.select("host", "key", "html").mapInArrow(run, "host long, key long, " + ", ".join(f"{n} array<long>" for n in fields))
    return rows.dropDuplicates(["host", "key"])


def _inlined(nodes: DataFrame) -> DataFrame:
    return nodes.select("host", "key", F.inline(F.arrays_zip("node", "presentation", "content")))


def style_tree(nodes: DataFrame) -> DataFrame:
    """(host, node, pages, importance) of every node of the hosts' merged trees.

    With m pages, a presentation that p of them share adds -p log_m(p), and a content that c pages
    share takes (c / m) log_m(c) from 1. Each is 1 when all pages differ and 0 when they
    agree. On fewer than PAGES pages the importance is 1.
    """
    looks = nodes.groupBy("host", "node", "presentation").agg(F.count("*").alias("c")).select("host", "node", "c", F.lit(True).alias("look"))
    reads = nodes.groupBy("host", "node", "content").agg(F.count("*").alias("c")).select("host", "node", "c", F.lit(False).alias("look"))
    both = looks.unionByName(reads)
    c = F.col("c").cast("double")
    sums = both.groupBy("host", "node").agg(
        F.sum(F.when(F.col("look"), c)).alias("pages"),
        F.sum(F.when(F.col("look"), c * F.log(c))).alias("look"),
        F.sum(F.when(~F.col("look"), c * F.log(c))).alias("content"),
    )
    m = F.col("pages")
    look = 1 - F.col("look") / (m * F.log(m))
    content = 1 - F.col("content") / (m * F.log(m))
    return sums.select("host", "node", "pages", F.when(m < PAGES, 1.0).otherwise(PRESENTATION * look + (1 - PRESENTATION) * content).alias("importance"))


def main_text(df: DataFrame, url: str = "url", column: str = "html") -> DataFrame:
    """``df`` with ``main_text`` and ``removed_nodes``, the number of the page's nodes of low importance that went.

    Pages of one host are compared, each distinct page once; a null or odd url belongs to the empty host. A null or empty
    page has an empty text, and so has one that holds nothing but other roles. Outermost article
    and main elements and those above them are protected; any other branch of low importance goes, also inside an
    article, unless nothing would be left. Rows that are equal have equal results; columns of these names are replaced.
    """
    base = df.drop("main_text", "removed_nodes")
    source = F.coalesce(F.col(column), F.lit(""))
    host = F.xxhash64(host_of(F.col(url)))
    nodes = materialize(_nodes(base.select(host.alias("host"), F.xxhash64(host, source).alias("key"), source.alias("html"))))
    low = style_tree(_inlined(nodes)).where(F.col("importance") < IMPORTANCE).select("host", "node")
    removed = _inlined(nodes).select("host", "node", "key").join(low, ["host", "node"]).groupBy("key").agg(F.collect_list("node").alias("low"))
    whole = rows_of(base, column, url=url)
    whole = whole.select("row", "text", F.xxhash64(F.xxhash64(host_of(F.col("url"))), F.coalesce("text", F.lit(""))).alias("key"))
    joined = whole.join(removed.withColumnRenamed("key", "low_key"), F.col("key") == F.col("low_key"), "left").select("row", "text", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for data, low in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist()):
                page = _page(data)
                kept, went = page.kept(set(low or ()))
                texts.append(page.text_of(kept))
                counts.append(went)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), pa.array(counts, pa.int64())], names=["row", "text", "main", "low"])

    schema = whole.select("row", "text", F.lit("").alias("main"), F.lit(0).cast("long").alias("low")).schema
    done = joined.mapInArrow(run, schema)
    return done.select(*columns_of(base.columns, column), F.col("main").alias("main_text"), F.col("low").alias("removed_nodes"))
