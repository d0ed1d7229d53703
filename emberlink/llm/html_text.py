"""Main text of web pages by a site style tree.

All pages of a host are merged into one tree: containers with the same path of tags, classes and
ids are one node. Two entropies make a node's importance: of its presentation, the sequences of
children it shows, and of its content, the texts it holds. Both are on a scale of pages: a node
that looks and reads the same everywhere has importance 0, one with a text of its own on every
page 1. Composite importance is ``(1 - DECAY**l) * presentation + DECAY**l * content``, ``l``
being the number of presentations. A container is unimportant if both this and the importance of its
content alone are below ``LEAST``. It goes, with all it holds, where its text is one that ``LEAST_PAGES``
pages show and nothing in it was found important; a text of a page's own stays wherever it stands.
Pages of a host with equal texts count as one, so copies of a page do not make it look like a template.

A prior stands beside it, since many hosts show few pages: containers whose tag, or a whole class or
id, names their purpose (menus, footers, adverts, forms, comments, ...) have importance 0 on every host.
Names do not count on the page, its article and headings; ids do not on sections. A form passes if it
holds the marked article, and so does a named element if no article is outside (not comments).
Where a page marks its article (``article``, ``main``), text outside is not main text, and the
marked element itself and its paragraphs are never judged by statistics, only the containers
within: equal articles on many pages are still articles.

Hosts are merged by aggregation (no task holds a host). What statistics remove is a list of few
contents a host; it is broadcast up to ``BROADCAST_ROWS`` rows, and beyond that joined on salted hosts.

Defined results: a null or empty html has an empty text. An attribute whose quote never
ends stops with its tag, and a comment or script without end runs to the end of the page. Tags may
be unbalanced; elements left open end with what is around them. Repeated rows are read alike (and
count as pages), pages without a host make up one, and an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from xxhash import xxh3_64_intdigest

from emberlink.llm.common import cut_lineage, fresh, table

DECAY = 0.9
LEAST = 0.3
LEAST_PAGES = 8  # of a host, before statistics judge its nodes
BROADCAST_ROWS = 100_000


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


# Fixed values of the markup language.
VOID = _words("area base col embed hr img input link meta param source track wbr")
RAW = _words("script style textarea title xmp iframe noembed noframes")
INLINE = _words(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var"
)
CLOSES_P = _words(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre "
    "search section summary table ul"
)
#: Each ends the open elements named, up to one of those behind the bar.
IMPLIED = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "thead": ("thead tbody tfoot tr td th", "table"), "tbody": ("thead tbody tfoot tr td th", "table"), "tfoot": ("thead tbody tfoot tr td th", "table"),
    "option": ("option", "select"), "optgroup": ("option optgroup", "select"),
}
IMPLIED = {tag: (_words(ends), _words(bounds)) for tag, (ends, bounds) in IMPLIED.items()}
CONTAINERS = _words("article aside body center details div dl fieldset figure footer form header main menu nav ol search section table ul")

# The prior: tags and names of what is not an article.
BOILERPLATE_TAGS = _words(
    "nav footer aside form head script style noscript template svg math object iframe button select textarea dialog menu audio video canvas map search fieldset"
)
_NAMES = (
    r"(?:ad|ads|advert\w*|adsense|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|copyright|disclaimer|disqus|footer|gdpr|masthead|menu|menus|modal|nav|navbar|"
    r"navigation|newsletter|notice|notices|pagination|pager|popup|promo\w*|related|replies|respond|share|sharing|sidebar|sidebars|site-header|skip-link|social|sponsor\w*|subscribe|toolbar|widgets?)"
)
#: A whole class or id: names, with words of place before and of form after them ("site-footer", "cookie-bar"; not "has-sidebar", "related-work").
BOILERPLATE_NAMES = re.compile(
    rf"(?:(?:site|page|main|top|bottom|primary|secondary|global|mobile|sticky|post|entry|article)[_-]+)*{_NAMES}(?:[_-]+{_NAMES})*"
    r"(?:[_-]+(?:bar|box|slot|unit|area|list|links?|icons?|buttons?|block|form|popup|\d+(?:x\d+)?))*",
    re.I,
)
COMMENT_NAMES = re.compile(r"(?:comments?|commentlist|replies|respond|disqus)", re.I)
NAMELESS = _words("html body main h1 h2 h3 h4 h5 h6")  # never judged by names; sections only by class, as their ids are anchors
PASSING = _words("form fieldset")  # these, and what only a name tells, pass if they hold the article
BOILERPLATE_ROLES = _words("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar")
ARTICLES = _words("article main")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</(?:>|[^a-zA-Z>][^>]*+(?:>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"""(?<![^\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I) for tag in RAW}


@dataclass(slots=True)
class Open:
    """An element that is open."""

    tag: str
    path: int  # of a container
    gone: int  # by the prior: 0 if not, GONE, or a number in Reader.doubts
    inside: bool  # an article or main element
    container: int  # the innermost, in Page.containers
    first: int  # the first block that it holds
    children: list[str] = field(default_factory=list)


@dataclass(slots=True)
class Page:
    """Blocks of text, the containers around them, and the containers' looks and contents."""

    blocks: list[tuple[str, bool, int]] = field(default_factory=list)  # text, in an article, container
    containers: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])  # path, container around it
    contents: list[int] = field(default_factory=lambda: [0])  # of the containers: path and text
    nodes: list[tuple[int, int, int, int]] = field(default_factory=list)  # path, path around it, look, content
    text: int = 0  # hash of all text
    marked: bool = False  # whether the page marks its article


def _decode(piece: str) -> str:
    if "&" not in piece:
        return piece
    if piece.count("&") == piece.count("&amp;"):
        return piece.replace("&amp;", "&")
    return entities.unescape(piece)


def _hash(text: str) -> int:
    return xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


GONE = -1
_ODD = 0x9E3779B97F4A7C15  # any odd number: tells equal texts at different paths apart


def _named(tag: str, names: dict[str, str]) -> list[str]:
    """Classes and ids that name a purpose other than the article."""
    if tag in NAMELESS:
        return []
    labels = names.get("class", "").split()
    if tag != "section" and "id" in names:
        labels.append(names["id"].strip())
    found = [x for x in labels if BOILERPLATE_NAMES.fullmatch(x)]
    # Of an element that marks an article, only the name of a comment says that it is none.
    return [x for x in found if COMMENT_NAMES.fullmatch(x)] if tag in ARTICLES else found


class Reader:
    """One pass over a page's markup."""

    def __init__(self) -> None:
        self.page = Page()
        self.stack = [Open("", 0, 0, False, 0, 0)]
        self.open: Counter[str] = Counter()
        self.parts: list[str] = []
        # What goes unless it holds the article: the doubt around it, whether by name only, whether it holds one.
        self.doubts: list[list] = [[0, False, False]]
        self.articles: set[int] = set()  # doubts (or 0) around the marked elements
        self.blocks: list[tuple[str, bool, int, int]] = []  # as the page's, and the doubt around
        self.nodes: list[tuple[int, int, int, int, int]] = []  # container, look, first and last block, doubt around

    def end_block(self) -> None:
        if not self.parts:
            return
        text, top = " ".join("".join(self.parts).split()), self.stack[-1]
        if text and top.gone != GONE:
            self.blocks.append((text, top.inside, top.container, top.gone))
        self.parts.clear()

    def close(self) -> None:
        self.end_block()
        node = self.stack.pop()
        self.open[node.tag] -= 1
        if node.path and node.gone != GONE:
            self.nodes.append((node.container, _hash(" ".join(node.children)), node.first, len(self.blocks), node.gone))

    def judge(self, around: int, tag: str, names: dict[str, str], inside: bool) -> int:
        """What the prior says of an element."""
        if around == GONE:
            return GONE
        if tag in ("html", "body"):
            return around
        role = names.get("role", "").lower()
        if (tag in BOILERPLATE_TAGS and tag not in PASSING) or (tag == "header" and not inside) or (role in BOILERPLATE_ROLES and role != "form"):
            return GONE
        found = _named(tag, names)
        if any(COMMENT_NAMES.fullmatch(x) for x in found):
            return GONE
        if found or tag in PASSING or role == "form":
            self.doubts.append([around, bool(found), False])
            return len(self.doubts) - 1
        return around

    def settle(self) -> None:
        """Drop what stays doubtful. A form that holds an article passes; a name, if no article is outside."""
        for doubt in self.articles:
            while doubt and not self.doubts[doubt][2]:
                self.doubts[doubt][2] = True
                doubt = self.doubts[doubt][0]
        for names_pass in (False, True):
            gone = [False]
            for around, by_name, holds in self.doubts[1:]:
                gone.append(gone[around] or not holds or (by_name and not names_pass))
            self.page.marked = any(not gone[doubt] for doubt in self.articles)
            if self.page.marked:
                break
        sums = [0]
        for text, inside, container, doubt in self.blocks:
            sums.append(sums[-1] + (0 if gone[doubt] else _hash(text)))
            if not gone[doubt]:
                self.page.blocks.append((text, inside, container))
        page = self.page
        page.text = sums[-1] % (1 << 62)
        for container, look, first, last, doubt in self.nodes:
            if not gone[doubt]:
                path, around = page.containers[container]
                page.contents[container] = (sums[last] - sums[first] + path * _ODD) % (1 << 62)
                page.nodes.append((path, page.containers[around][0], look, page.contents[container]))

    def close_all(self, ends: frozenset[str], bounds: frozenset[str]) -> None:
        """Close the open elements in ``ends``, with what they hold, up to one in ``bounds``."""
        while any(self.open[tag] for tag in ends):
            depth = next(d for d in range(len(self.stack) - 1, -1, -1) if self.stack[d].tag in ends or self.stack[d].tag in bounds)
            if self.stack[depth].tag not in ends:
                return
            while len(self.stack) > depth:
                self.close()

    def end_tag(self, tag: str) -> None:
        if tag in INLINE:
            return
        self.end_block()
        if self.open[tag]:
            while self.stack[-1].tag != tag:
                self.close()
            self.close()

    def start_tag(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.parts.append(" ")
        if tag == "br" or tag in INLINE:
            return
        self.end_block()
        if tag in CLOSES_P:
            self.close_all(_words("p"), CONTAINERS)
        if tag in IMPLIED:
            self.close_all(*IMPLIED[tag])
        top = self.stack[-1]
        top.children.append(tag)
        if tag in VOID:
            return
        names = {k.lower(): a or b or c for k, a, b, c in _NAMED.findall(attributes)} if attributes else {}
        label = f"{names.get('class', '')} {names.get('id', '')}".strip()
        gone = self.judge(top.gone, tag, names, top.inside)
        marks = tag in ARTICLES or names.get("role", "").lower() == "main"
        inside = top.inside or marks
        if marks and gone != GONE:
            self.articles.add(gone)
        path, container = 0, top.container
        if tag in CONTAINERS and tag not in ARTICLES and tag != "body":
            around = self.page.containers[container][0]
            path, container = _hash(f"{around}/{tag}.{label}"), len(self.page.containers)
            self.page.containers.append((path, top.container))
            self.page.contents.append(0)
        self.stack.append(Open(tag, path, gone, inside, container, len(self.blocks)))
        self.open[tag] += 1

    def read(self, source: str) -> Page:
        at = 0
        while found := _TOKEN.search(source, at):
            if found.start() > at:
                self.parts.append(_decode(source[at : found.start()]))
            at = found.end()
            tag = found[2] and found[2].lower()
            if tag is None:
                if found[0].startswith("<![CDATA["):
                    self.parts.append(found[0][9:].removesuffix("]]>"))
            elif found[1]:
                self.end_tag(tag)
            elif tag in RAW:
                closing = _RAW_END[tag].search(source, at)
                at = closing.end() if closing else len(source)
            else:
                self.start_tag(tag, found[3])
        self.parts.append(_decode(source[at:]))
        while len(self.stack) > 1:
            self.close()
        self.end_block()
        self.settle()
        return self.page


def parse(source: str | None) -> Page:
    return Reader().read(source or "")


def main_text(source: str | None, removed: frozenset[int] = frozenset()) -> str:
    """The main text of a page, less the containers whose contents are in ``removed``.

    Those that hold a container stay whose path is there as a negative number (``~path``).
    """
    page = parse(source)
    n = len(page.containers)
    gone = [False] * n
    if removed:
        spared = [~path in removed for path, _ in page.containers]
        for i in range(n - 1, 0, -1):
            spared[page.containers[i][1]] |= spared[i]
        for i in range(1, n):
            gone[i] = gone[page.containers[i][1]] or (page.contents[i] in removed and not spared[i])
    return "\n".join([text for text, inside, container in page.blocks if (inside or not page.marked) and not gone[container]])


def host(url: str):
    """A url's host as a column; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def unimportant(pages: DataFrame) -> DataFrame:
    """(``host``, ``entry``): what goes by the style trees of all hosts, as :func:`main_text` takes it.

    The contents, shown on ``LEAST_PAGES`` pages or more, of unimportant containers; and ``~path`` of
    the important containers directly within such.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for site, source in zip(batch["host"], batch["html"]):
                page = parse(source)
                # The root (path 0) counts pages; each look (0) or content (1) of a page is one row.
                nodes = {(0, 0, 0, 0)}
                for path, around, look, content in page.nodes:
                    nodes.add((path, around, 0, look))
                    nodes.add((path, around, 1, content))
                rows.append((site, page.text, np.array(sorted(nodes), "<i8").tobytes()))
            yield pd.DataFrame(rows, columns=["host", "page", "nodes"])

    def values_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes = np.frombuffer(b"".join(batch["nodes"]), "<i8").reshape(-1, 4)
            sites = np.repeat(batch["host"].to_numpy(), batch["nodes"].map(len).to_numpy() // 32)
            yield pd.DataFrame({"host": sites, "path": nodes[:, 0], "around": nodes[:, 1], "kind": nodes[:, 2], "value": nodes[:, 3]})

    found = pages.select(host("url").alias("host"), "html").mapInPandas(read, "host string, page long, nodes binary")
    # Equal texts of a host are one page, whichever task read them.
    apart = found.groupBy("host", "page").agg(F.min("nodes").alias("nodes")).select("host", "nodes")
    found = apart.mapInPandas(values_of, "host string, path long, around long, kind long, value long")
    values = cut_lineage(found.groupBy("host", "path", "around", "kind", "value").agg(F.count("*").cast("double").alias("n")), "html-nodes")
    sizes = values.where("path = 0").select("host", F.col("n").alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    is_look = F.col("kind") == 0
    sums = values.where("path <> 0").groupBy("host", "path", "around").agg(
        F.sum(F.when(is_look, F.col("n"))).alias("looked"),
        F.sum(F.when(is_look, 1)).alias("looks"),
        F.sum(F.when(is_look, F.col("n") * F.log("n"))).alias("look_logs"),
        F.sum(F.when(~is_look, F.col("n"))).alias("shown"),
        F.sum(F.when(~is_look, F.col("n") * F.log("n"))).alias("content_logs"),
    )
    judged = sums.join(sizes, "host").where(F.col("shown") >= LEAST_PAGES)
    presentation = (F.log("looked") - F.col("look_logs") / F.col("looked")) / F.log("pages")
    content = 1 - F.col("content_logs") / F.col("shown") / F.log("pages")
    weight = F.pow(F.lit(DECAY), F.col("looks"))
    importance = F.greatest((1 - weight) * presentation + weight * content, content)
    judged = cut_lineage(judged.select("host", "path", "around", (importance < LEAST).alias("low")), "html-judged")
    low = judged.where("low").select("host", "path")
    repeated = values.where((F.col("kind") == 1) & (F.col("n") >= LEAST_PAGES)).join(low, ["host", "path"]).select("host", F.col("value").alias("entry"))
    spared = judged.where("not low").join(low.select("host", F.col("path").alias("around")), ["host", "around"])
    return repeated.unionByName(spared.select("host", F.bitwise_not("path").alias("entry")))


def extract(pages: DataFrame, text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add the main text of ``html`` to pages (``url``, ``html``)."""
    site, drop, salt = (fresh(pages.columns, c) for c in ("host", "removed", "salt"))
    lists = cut_lineage(unimportant(pages), "html-removed").groupBy("host").agg(F.collect_set("entry").alias(drop))
    lists = lists.withColumnRenamed("host", site)
    named = pages.withColumn(site, host("url"))
    if (lists.select(F.sum(F.size(drop))).first()[0] or 0) <= broadcast_rows:
        joined = named.join(F.broadcast(lists), site, "left")
    else:
        parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        copies = lists.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        joined = named.withColumn(salt, F.pmod(F.xxhash64("url", "html"), F.lit(parts)).cast("int")).join(copies, [site, salt], "left").drop(salt)

    @F.pandas_udf("string")
    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sources, removed in batches:
            yield pd.Series([main_text(s, frozenset(r.tolist()) if r is not None else frozenset()) for s, r in zip(sources, removed)], dtype=object)

    return joined.withColumn(text_col, read.asNondeterministic()(F.col("html"), F.col(drop))).drop(site, drop)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
