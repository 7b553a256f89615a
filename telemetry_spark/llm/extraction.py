"""Main text of web pages by consensus of each host's pages.

Method. A page's elements are read into a tree. Of the containers that hold most of the page's own text the deepest is taken that leaves
out no article text: text of an outer container itself, or within ``article`` or ``main``, is never left out. Containers are named by
their generalised path, tags and classes without digits; every page votes for the path of its best container, and Spark counts the
votes by host and path. The path with most of a host's votes is where that host keeps its articles. With its vote a page names the
containers beside its best one and a hash of what each says. A container is beside the article if on most of the host's pages that have it
there, its text is also that of a page with another article. Every page is read again, and all its visible text is kept but that of
containers beside the host's path; a page without that path, or with ``VOTE_SHARE`` of its text in those, keeps them too.

What never counts as text: scripts, styles, forms and their controls; elements, roles and classes of menus, page headers, footers, sidebars, notices,
adverts, sharing, related links and reader comments; hidden elements. A class or id counts as a whole (``related``, ``cookie-notice``, not
``related-work``), and does not hide an element with ``VOTE_SHARE`` of the page's text, unless an ``article`` or ``main`` beside it has more than ``TRIFLE`` of that. Blocks end at block-level elements; a line break is white
space. Votes are added up in every task before they are shuffled, so a host with a third of all pages is no hot spot. A host's winner is
one row, with the paths beside it; up to ``broadcast_hosts`` of them go to every task, more are joined by host.

Defined results: a null or empty page has the empty text; a page with no host (null url, or no ``://``) has no vote and keeps all its visible text; of two
paths with equal votes the first in alphabetical order wins; rows that repeat an id are read each by itself; no rows give no rows;
other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Set
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_spark.llm.common import LOWER, UPPER, bounded, written

#: Share of a page's text that a container needs for a vote, and what others beside it may hold.
VOTE_SHARE, BESIDE_SHARE = 0.7, 0.02
#: Text in ``article`` or ``main`` of less than this share of another element's is a teaser.
TRIFLE = 0.1

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)", re.S)
#: What ends a tag, or opens a quoted value in it.
IN_TAG = re.compile(r"[<>]|=\s*+([\"'])")
ATTRIBUTE = re.compile(r"([A-Za-z][-\w:]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title iframe noembed noframes xmp template noscript svg math object select".split())
#: Their ends, in the page as it is: lower-casing a text may lengthen it.
RAW_END = {name: re.compile("</" + "".join(f"[{c}{c.upper()}]" for c in name)) for name in RAW}
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article blockquote body center div dl main ol section table tbody td tr ul".split())
#: Opening one of these ends an open element of the kinds named.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
#: An implied end does not reach out of these.
SCOPES = frozenset("table ul ol dl article section div main body td th aside nav footer header form blockquote".split())
NO_TEXT = frozenset("nav footer aside form button dialog menu search label fieldset input audio video canvas".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
NO_TEXT_WORDS = frozenset(
    "nav navbar navigation menu topbar sidebar side aside footer masthead breadcrumb breadcrumbs pagination pager "
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall newsletter subscribe subscription signup login "
    "comment comments disqus replies reply respond share sharing social related recommended recommendations widget widgets skip".split())
#: Words that may stand beside these in the name of a class or id.
PLACE_WORDS = frozenset("left right top bottom main primary secondary site global box container wrapper wrap list area block link links".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WORD, DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+(?:x\d+)?")


#: Steps of a path that are kept, counted from the container up.
PATH_STEPS = 12


@dataclass
class Node:
    """An element: a container has a path of its own, any other block that of the container it is in."""

    tag: str
    path: str
    parent: Node | None
    hidden: bool = False
    #: Where the innermost element begins whose name alone hides this one; None if it is visible or hidden for another reason.
    named: int | None = None
    in_article: bool = False
    depth: int = 0
    chars: int = 0


@dataclass
class Page:
    """Containers in the order they open, and blocks of text with the container each is in."""

    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[str, Node]] = field(default_factory=list)


def attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)} if rest.strip() else {}


def is_hidden(tag: str, known: dict[str, str], parent: Node) -> bool:
    """Whether an element's tag, role or state says that it holds none of the article's text."""
    if tag in NO_TEXT or tag == "header" and not parent.in_article:
        return True
    if not known or tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in known or known.get("aria-hidden") == "true" or known.get("role", "").lower() in NO_TEXT_ROLES:
        return True
    return "display:none" in known.get("style", "").replace(" ", "").lower()


def is_named_hidden(tag: str, known: dict[str, str], parent: Node) -> bool:
    """Whether a class or the id, taken whole, names something beside the article. Ids of headings come from their text."""
    if not known or tag in ("html", "body", "article", "main"):
        return False
    for name in f"{known.get('class', '')} {'' if tag in HEADINGS else known.get('id', '')}".lower().split():
        words = set(WORD.findall(DIGITS.sub(" ", name))) - PLACE_WORDS
        if words and all(w in NO_TEXT_WORDS or w == "header" and not parent.in_article for w in words):
            return True
    return False


def step_of(tag: str, known: dict[str, str]) -> str:
    """An element's place in a generalised path: its tag and classes, without digits."""
    classes = sorted({re.sub(r"\d+", "", c) for c in known.get("class", "").split()} - {""})
    return ".".join([tag, *classes])


class Reader:
    """Builds a page from its tokens. The stack holds open blocks, and inline elements only where they hide their text.

    Elements that begin at one of ``shown`` are not hidden by their names. ``named`` counts the text of those that are.
    """

    def __init__(self, shown: Set[int] = frozenset()):
        self.page, self.text, self.shown = Page(), [], shown
        self.named: dict[int, int] = {}
        self.outer: dict[int, tuple[int | None, bool]] = {}
        root = Node("html", "html", None)
        self.stack, self.container = [root], root
        self.page.nodes.append(root)

    def add(self, text: str) -> None:
        top = self.stack[-1]
        if not top.hidden:
            self.text.append(text)
        elif top.named is not None:
            self.named[top.named] += len(" ".join(text.split()))

    def main_named(self) -> set[int]:
        """Where elements begin that their names hide although they hold most of the page's text.

        An article in plain sight has the text, however short it is beside an advert, unless it is a trifle.
        """
        sizes = dict(self.named)
        total = sum(len(text) for text, _ in self.page.blocks) + sum(sizes.values())
        for at in sorted(sizes, reverse=True):  # an element begins after the one it is in
            if (outer := self.outer[at][0]) is not None:
                sizes[outer] += sizes[at]
        article = sum(len(text) for text, node in self.page.blocks if node.in_article)
        return {
            at for at, size in sizes.items()
            if size > VOTE_SHARE * total and (self.outer[at][1] or article < TRIFLE * size)}

    def flush(self) -> None:
        raw = "".join(self.text)
        self.text.clear()
        block = " ".join((html.unescape(raw) if "&" in raw else raw).split())
        if block:
            node = next(n for n in reversed(self.stack) if not n.hidden)
            node = node if node.tag in CONTAINERS or node.parent is None else node.parent
            node.chars += len(block)
            self.page.blocks.append((block, node))

    def close(self, upto: int) -> None:
        self.flush()
        del self.stack[upto:]

    def end(self, name: str) -> None:
        at = next((i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i].tag == name), 0)
        if at and name not in BLOCK:
            del self.stack[at:]
        elif at:
            self.close(at)
        elif name == "p":
            self.flush()

    def start(self, name: str, rest: str, at: int) -> None:
        if name in BLOCK:
            self.flush()
            self.imply_ends(name)
        top = self.stack[-1]
        known = attributes(rest)
        named, hidden = top.named, top.hidden and top.named is None or is_hidden(name, known, top)
        if hidden:
            named = None
        elif at not in self.shown and is_named_hidden(name, known, top):
            self.named[at], self.outer[at], named = 0, (named, top.in_article), at
        hidden = hidden or named is not None
        if name not in BLOCK:
            if (hidden, named) != (top.hidden, top.named):
                self.stack.append(Node(name, top.path, top, hidden, named))
            return
        if name == "body" and len(self.stack) > 1:
            return
        inside = top if top.tag in CONTAINERS or top.parent is None else top.parent
        node = Node(name, inside.path, inside, hidden, named, top.in_article or name in ("article", "main"), inside.depth)
        if name in CONTAINERS and not hidden:
            node.path = ">".join([*inside.path.split(">"), step_of(name, known)][-PATH_STEPS:])
            node.depth += 1
            self.page.nodes.append(node)
        self.stack.append(node)

    def imply_ends(self, name: str) -> None:
        """A block ends an open paragraph; a list item, cell or row one of its kind."""
        for ends in ({"p"}, ENDS.get(name, frozenset())):
            for i in range(len(self.stack) - 1, 0, -1):
                tag = self.stack[i].tag
                if tag in ends:
                    self.close(i)
                    break
                if tag in SCOPES:
                    break


def tag_end(page: str, at: int, unclosed: set[str]) -> tuple[int, int]:
    """Where a tag's attributes end and where the page goes on. A quote is open to the next of its kind; ``unclosed`` are those
    with none left in the page, which open nothing."""
    while m := IN_TAG.search(page, at):
        if not (quote := m[1]):
            return m.start(), m.end() if m[0] == ">" else m.start()
        at = m.end()
        if quote not in unclosed:
            if (end := page.find(quote, at)) < 0:
                unclosed.add(quote)
            else:
                at = end + 1
    return len(page), len(page)


def read(page: str) -> Page:
    """Containers and blocks of a page. An element that holds most of its text is read whatever its name."""
    reader = read_with(page, Reader())
    shown = reader.main_named()
    return read_with(page, Reader(shown)).page if shown else reader.page


def read_with(page: str, reader: Reader) -> Reader:
    at, head, unclosed = 0, False, set()
    while m := TOKEN.search(page, at):
        if m.start() > at and not head:
            reader.add(page[at : m.start()])
        at, name, rest = m.end(), (m["name"] or "").lower(), ""
        if name:
            end, after = tag_end(page, at, unclosed)
            rest, at = page[at:end], after
        if not name:
            if m[0].startswith("<![CDATA[") and not head:
                reader.add(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
        elif name in ("head", "body"):
            head = name == "head" and not m["end"]
            if name == "body" and not m["end"]:
                reader.start(name, rest, m.start())
        elif m["end"]:
            if not head:
                reader.end(name)
        elif name in RAW:
            found = None if name in unclosed else RAW_END[name].search(page, at)
            if not found:
                unclosed.add(name)
            if found and not rest.endswith("/"):
                at = found.start()
            elif name in ("script", "style", "textarea", "title"):
                at = len(page)
        elif head or name == "html":
            continue
        elif name == "br":
            reader.add(" ")
        elif name in VOID:
            if name == "hr":
                reader.flush()
        else:
            reader.start(name, rest, m.start())
    if at < len(page) and not head:
        reader.add(page[at:])
    reader.flush()
    return reader


def container_sizes(page: Page) -> list[int]:
    """Characters of text within each container, in the order of ``page.nodes``."""
    place = {id(n): i for i, n in enumerate(page.nodes)}
    sizes = [n.chars for n in page.nodes]
    for i in range(len(page.nodes) - 1, 0, -1):  # a container opens after the one it is in
        sizes[place[id(page.nodes[i].parent)]] += sizes[i]
    return sizes


def path_scores(page: Page) -> dict[str, tuple[float, int]]:
    """Scores of the paths whose containers hold most of the page's text: the share of article text kept, then the level.

    What a container has besides the one within it is article text if it stands there itself or in an article, or if it is no trifle.
    """
    sizes = container_sizes(page)
    if not sizes[0]:
        return {}
    by_path: dict[str, tuple[float, int]] = {}
    kept, beside, outer = sizes[0], 0, None
    for node, size in zip(page.nodes, sizes, strict=True):  # two containers with so much text are one within the other
        if size < VOTE_SHARE * sizes[0]:
            continue
        if outer:
            rest = outer[1] - size
            beside += rest
            if outer[0].chars or outer[0].in_article or beside > BESIDE_SHARE * sizes[0]:
                kept -= rest
        outer = node, size
        by_path[node.path] = max(by_path.get(node.path, (0.0, 0)), (kept / sizes[0], node.depth))
    return by_path


def best_of(scores: dict[str, tuple[float, int]]) -> str:
    return min(scores, key=lambda p: (-scores[p][0], -scores[p][1], p))


def within(page: Page, paths: Set[str], but: Set[int] = frozenset()) -> set[int]:
    """The containers that have one of the paths, and all in them, but not those of ``but``."""
    inside: set[int] = set()
    for node in page.nodes:
        if id(node) not in but and (node.path in paths or id(node.parent) in inside):
            inside.add(id(node))
    return inside


def around(page: Page, path: str) -> set[int]:
    """The containers around those that have a path."""
    found: set[int] = set()
    for node in page.nodes:
        outer = node.parent if node.path == path else None
        while outer and id(outer) not in found:
            found.add(id(outer))
            outer = outer.parent
    return found


def digest(texts: list[str]) -> int:
    return xxhash.xxh64_intdigest("\n".join(texts)) - (1 << 63)


def beside(page: Page, path: str) -> Iterator[tuple[str, int, int]]:
    """Path and text of each container beside those that have a path, and the text of the latter, as hashes."""
    own, outer = within(page, {path}), around(page, path)
    said: dict[int, list[str]] = {}
    side_of: dict[int, Node] = {}
    for node in page.nodes:
        if id(node) in own or id(node) in outer:
            continue
        side = side_of[id(node)] = side_of.get(id(node.parent), node)
        said.setdefault(id(side), [])
    if not said:
        return
    sides = {id(n): n for n in side_of.values()}
    for text, node in page.blocks:
        if id(node) in side_of:
            said[id(side_of[id(node)])].append(text)
    article = digest([text for text, node in page.blocks if id(node) in own])
    for key, texts in said.items():
        if texts and not sides[key].in_article:
            yield sides[key].path, digest(texts), article


def extract(html_text: str | None, path: str | None, sides: Iterable[str] = ()) -> str:
    """A page's visible text, without the containers that its host has beside those at its path."""
    page = read(html_text or "")
    whole = [text for text, _ in page.blocks]
    sides = frozenset(sides) - {path}
    if not path or not sides or not any(id(n) in (own := within(page, {path})) for _, n in page.blocks):
        return "\n".join(whole)
    left_out = within(page, sides, own | around(page, path))
    kept = [text for text, node in page.blocks if id(node) not in left_out]
    return "\n".join(kept if sum(map(len, kept)) > (1 - VOTE_SHARE) * sum(map(len, whole)) else whole)


def host_of(url: F.Column) -> F.Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, path, sides``: where the pages of each host keep their text, and the paths beside it."""

    def cast_votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter[tuple] = Counter()
            for host, text in zip(batch["host"], batch["html"], strict=True):
                page = read(text or "")
                if scores := path_scores(page):
                    path = best_of(scores)
                    counts[host, path, "", 0, 0] += 1
                    counts.update((host, path, *side) for side in beside(page, path))
            yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["host", "path", "side", "said", "article", "n"])

    hosts = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).where("host <> ''")
    voted = hosts.mapInPandas(cast_votes, "host string, path string, side string, said bigint, article bigint, n bigint")
    texts = voted.groupBy("host", "path", "side", "said").agg(
        F.sum("n").alias("n"), (F.min("article") < F.max("article")).alias("again"))
    sides = texts.groupBy("host", "path", "side").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("again"), F.col("n"))).alias("again"))
    summed = sides.groupBy("host", "path").agg(
        F.sum(F.when(F.col("side") == "", F.col("n"))).alias("votes"),
        F.collect_list(F.when(2 * F.col("again") > F.col("n"), F.col("side"))).alias("sides"))
    winner = F.min_by(F.struct("path", "sides"), F.struct(-F.col("votes"), F.col("path")))
    return summed.groupBy("host").agg(winner.alias("winner")).select("host", "winner.path", "winner.sides")


def extract_pages(
    pages: DataFrame, broadcast_hosts: int = 200_000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars, path``: path is the host's, null where there is none."""
    # With the hosts broadcast no page moves, so a host of any size is no hot spot; beyond the bound Spark splits the join.
    paths = bounded(written(host_paths(pages, url_col, html_col), "host-paths"), broadcast_hosts)

    @F.pandas_udf("string")
    def text_of(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, wanted, sides in batches:
            found = zip(texts, wanted, sides, strict=True)
            yield pd.Series([extract(t, p, () if s is None else s) for t, p, s in found], dtype=object)

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    joined = rows.withColumn("host", host_of(F.col("url"))).join(paths, "host", "left")
    found = joined.select("page_id", "url", text_of("html", "path", "sides").alias("text"), "path")
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"), "path")
