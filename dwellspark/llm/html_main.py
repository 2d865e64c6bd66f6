"""Main text of web pages by consensus host paths.

A page is read into blocks of text, each with the path of its container: tags and
classes from the root, numbers in classes generalised, so that pages made from one
template share paths.  First every page scores its containers and votes for the
best one; votes are summed per host and path in Spark.  Then every page is read
again with its host's winning path: the text is that of the containers on it, and
of the page's own best container where the page has none on it.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out by their tags, roles and names.  A name counts as a
whole ("cookie-notice", "sidebar-left", not "related-work" or "hidden-scroll"),
headings' names never do, and words that also name parts of an article
("discussion") count as an id or on a section only where the region is mostly
links.  Of a page's header headings stay, an article's own header stays whole.  A
block's white space becomes one space; blocks stand in page order, one per line.

Defined results: a null or empty page, and one without text, has the empty text; a
null url has no host of its own (the pages without one vote together); tags that
are never closed end with their parent; an empty table gives no rows.
"""

from __future__ import annotations

import html as html_lib
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellspark.llm.common import written

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|title)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r"(?:.*?</\1\s*+>|.*+)|<(/?)([a-z][a-z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)/?>|<[!?][^>]*+>", re.S | re.I)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp "
                   "small span strike strong sub sup time tt u var wbr br".split())
DROPPED = frozenset("head nav footer aside form button select option dialog menu script style noscript template svg iframe "
                    "textarea title object canvas audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Words of names that stand for boilerplate wherever they are ...
OUT = frozenset("nav navbar navigation menu sidebar footer ad ads adsense adv advert adverts advertisement advertisements sponsor "
                "sponsored promo cookie cookies consent gdpr banner popup modal overlay newsletter subscribe signup login comment "
                "comments disqus breadcrumb breadcrumbs pager toolbar masthead topbar".split())
# ... and those that also name parts of articles: as an id, or on a section, links must confirm them.
UNSURE = frozenset("advertising promotion notice notices subscription share sharing social related recommended recommendations "
                   "discussion replies reply respond pagination widget search hidden skip".split())
# Words that leave the sense of a name as it is ("sidebar-left", "post-comments"); any other word changes it ("related-work").
FILLER = frozenset("area bar block box button buttons container count desktop fixed follow global google icons inner item items "
                   "label left link links list main media message mobile outer page panel policy post posts primary reader readers "
                   "right secondary section site slot small sticky story stories text thread title top unit user users wrap wrapper "
                   "article articles blog bottom entry".split())
CONTENT = frozenset("article content post entry story main body text".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
NO_CONTAINER = HEADING | INLINE | frozenset("p li ul ol blockquote pre table tbody thead tr dl dt dd".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",)}
SCOPE = frozenset("ul ol dl table article section div main td th blockquote body".split())
KEEPS = ("td", "th", "article", "body")  # a stray end tag does not close these
LINKS = 0.5  # share of characters in links from which an unsure region is a list of links


@lru_cache(1 << 14)
def words_of(name: str) -> frozenset[str]:
    return frozenset(re.findall("[a-z]+", re.sub("([a-z])([A-Z])", r"\1-\2", name).lower()))


def sense(name: str, sure: bool) -> str:
    """What a whole class or id says: "out", "unsure" or nothing; ``sure``: unsure words count as well."""
    words = words_of(name)
    if not words <= OUT | UNSURE | FILLER:
        return ""
    return "out" if words & OUT or sure and words & UNSURE else "unsure" if words & UNSURE else ""


class Node:
    """An element. What it inherits is kept in it, so that no ancestor is asked again."""

    __slots__ = ("tag", "id", "parent", "path", "container", "article", "main", "out", "unsure", "heading", "heading_only", "link", "content")

    def __init__(self, tag: str, id_: int, parent: Node | None, attributes: str, paths: Paths):
        self.tag, self.id, self.parent, self.content = tag, id_, parent, False
        if parent:
            self.out, self.unsure, self.heading, self.heading_only = parent.out, parent.unsure, parent.heading, parent.heading_only
            self.link, self.article, self.main = parent.link, parent.article, parent.main
        else:
            self.out = self.heading = self.heading_only = self.link = False
            self.unsure = self.article = self.main = None
        self.out = self.out or tag in DROPPED
        self.heading = self.heading or tag in HEADING
        self.link = self.link or tag == "a"
        self.heading_only = self.heading_only or tag == "header" and not self.article
        label = tag
        if attributes and not self.out:
            classes = self.read(attributes)
            if classes:
                label += "." + ".".join(sorted(classes))
        if tag == "article":
            self.article = self.article or self
        elif tag == "main":
            self.main = self.main or self
        self.path = paths.child(parent.path if parent else -1, label)
        self.container = parent.container if parent and tag in NO_CONTAINER else self

    def read(self, attributes: str) -> set[str]:
        """Applies the attributes; the generalised classes."""
        classes: set[str] = set()
        said = set()
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                names = value.split()
                words = set().union(*map(words_of, names))
                self.content = self.content or bool(words & CONTENT)
                if name == "class":
                    classes = {re.sub(r"\d+", "#", x.lower()).replace(">", "_") for x in names}
                if "header" in words and not self.article:
                    self.heading_only = True
                said |= {sense(x, name == "class" and self.tag != "section") for x in names}
                if self.tag == "article" and words & {"comment", "comments", "reply"}:
                    self.out = True
            elif (name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true"
                    or name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
                self.out = True
        if self.tag not in HEADING and self.tag not in ("html", "body", "article", "main"):
            if "out" in said:
                self.out = True
            elif "unsure" in said:
                self.unsure = self.unsure or self
        return classes

    def worth(self) -> float:
        return {"article": 1.5, "main": 1.3, "body": 0.5, "html": 0.4}.get(self.tag, 1.0) + (0.3 if self.content else 0.0)


class Paths:
    """Paths of a page as (parent's number, label), so that a deep page needs no long texts."""

    def __init__(self) -> None:
        self.numbers: dict[tuple[int, str], int] = {}
        self.parts: list[tuple[int, str]] = []

    def child(self, parent: int, label: str) -> int:
        number = self.numbers.setdefault((parent, label), len(self.parts))
        if number == len(self.parts):
            self.parts.append((parent, label))
        return number

    def text(self, number: int) -> str:
        labels = []
        while number >= 0:
            number, label = self.parts[number]
            labels.append(label)
        return ">".join(reversed(labels))

    def find(self, path: str) -> int | None:
        number: int | None = -1
        for label in path.split(">"):
            number = self.numbers.get((number, label))
            if number is None:
                break
        return number


class Stack:
    """Open elements with the places of each tag, so that an end tag finds its start without a walk."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, at: int) -> None:
        while len(self.nodes) > at:
            self.places[self.nodes.pop().tag].pop()

    def last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else 0

    def end(self, tag: str) -> None:
        place = self.last(tag)
        if place and (tag in ("body", "html", "article", "table", "tr") or place >= max(map(self.last, KEEPS))):
            self.cut(place)

    def end_before(self, tag: str) -> None:
        """A new block ends a paragraph, and its like: an item the item before it."""
        ends = ("p", *CLOSES.get(tag, ()))
        scope = max(self.last(t) for t in SCOPE if t not in ends)
        lowest = len(self.nodes)
        for t in ends:
            places = self.places.get(t, ())
            first = bisect_right(places, scope)
            if first < len(places):
                lowest = min(lowest, places[first])
        self.cut(lowest)


class Page(NamedTuple):
    blocks: list[tuple[str, int, Node]]  # text, characters in links, innermost element
    nodes: list[Node]  # parents before their children
    paths: Paths


def read_page(page: str) -> Page:
    """The blocks that may be article text, and all elements. Time and memory grow with the page alone, however deep it is."""
    paths = Paths()
    root = Node("html", 0, None, "", paths)
    stack, nodes, blocks, buffer = Stack(root), [root], [], []
    linked = at = 0

    def put(text: str) -> None:
        nonlocal linked
        top = stack.nodes[-1]
        if text and not top.out:
            buffer.append(text)
            if top.link:
                linked += len(text)

    def end_block() -> None:
        nonlocal linked
        if buffer:
            top = stack.nodes[-1]
            text = "".join(buffer)
            text = " ".join((html_lib.unescape(text) if "&" in text else text).split())
            if text and not top.out and (top.heading or not top.heading_only):
                blocks.append((text, linked, top))
            buffer.clear()
        linked = 0

    for m in TOKEN.finditer(page):
        put(page[at:m.start()])
        at = m.end()
        if not m[3]:
            continue
        tag = m[3].lower()
        if tag in ("br", "wbr", "img"):
            if tag == "br":
                put(" ")
            continue
        if tag not in INLINE or tag == "label":
            end_block()
        if m[2]:
            stack.end(tag)
            continue
        if tag in VOID or tag == "html":
            continue
        if tag == "body":  # ends a head that was left open
            stack.cut(1)
        if tag not in INLINE:
            stack.end_before(tag)
        node = Node(tag, len(nodes), stack.nodes[-1], m[4], paths)
        nodes.append(node)
        stack.push(node)
    put(page[at:])
    end_block()
    return Page(confirmed(blocks), nodes, paths)


def confirmed(blocks: list[tuple[str, int, Node]]) -> list[tuple[str, int, Node]]:
    """The blocks without the unsure regions that are lists of links."""
    size: dict[int, list[int]] = {}
    for text, linked, node in blocks:
        if node.unsure:
            of = size.setdefault(node.unsure.id, [0, 0])
            of[0] += len(text)
            of[1] += linked
    out = {i for i, (chars, linked) in size.items() if linked >= LINKS * chars}
    return [b for b in blocks if not (b[2].unsure and b[2].unsure.id in out)] if out else blocks


def best_container(page: Page) -> tuple[str, float]:
    """The path of the container with the highest score, and the score.

    A container's score is the worth of its own blocks (characters, less those in
    links, a quarter for headings) and 0.6 of its inner containers' scores.
    """
    if not page.blocks:
        return "", 0.0
    score = [0.0] * len(page.nodes)
    used = [False] * len(page.nodes)
    for text, linked, node in page.blocks:
        score[node.container.id] += (len(text) - 2 * linked) / (4 if node.heading else 1)
        used[node.container.id] = True
    best, value = page.nodes[0], float("-inf")
    for node in reversed(page.nodes):
        if used[node.id]:
            own = (score[node.id] + 0.001) * node.worth()
            if own >= value:
                best, value = node, own
            if node.parent:
                up = node.parent.container.id
                score[up] += 0.6 * score[node.id]
                used[up] = True
    best = best.article or best.main or best  # the article around the best part of it
    return page.paths.text(best.path), max(value, 0.0)


def text_on(page: Page, path: str) -> str:
    number = page.paths.find(path)
    if number is None:
        return ""
    inside = [False] * len(page.nodes)
    for node in page.nodes:
        inside[node.id] = node.path == number or bool(node.parent and inside[node.parent.id])
    return "\n".join(text for text, _, node in page.blocks if inside[node.id])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path, pages, score: the path that most pages of the host vote for (then score, then path)."""
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [best_container(read_page(x or "")) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array([b[0] for b in best], pa.string()),
                                              pa.array([float(b[1]) for b in best])], ["host", "path", "score"])

    votes = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(vote, "host string, path string, score double")
    sums = votes.where("path <> ''").groupBy("host", "path").agg(F.count("*").alias("pages"), F.sum("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("pages"), F.desc("score"), "path"))
    return sums.withColumn("rank", rank).where("rank = 1").drop("rank")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path (the one used), text of every page."""
    winners = written(host_paths(pages).select(F.col("host").alias("of"), F.col("path").alias("winner")), "host-paths")
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    rows = rows.join(winners, rows["host"] == winners["of"], "left").drop("of")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, texts = [], []
            for page, winner in zip(batch.column("html").to_pylist(), batch.column("winner").to_pylist()):
                read = read_page(page or "")
                text = text_on(read, winner) if winner else ""
                if not text and read.blocks:
                    winner = best_container(read)[0]
                    text = text_on(read, winner)
                paths.append(winner if text else None)
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), batch.column("host"),
                                              pa.array(paths, pa.string()), pa.array(texts, pa.string())],
                                             ["page_id", "url", "host", "path", "text"])

    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, host string, path string, text string"
    return rows.mapInArrow(again, schema)
