"""HTML extraction by consensus of a host: which container holds the article on its pages.

Every page scores its containers by the text in them and votes with those scores on generalised
paths: the tags from the root down, each with its classes without their numbers. Votes are added up
per host, before and after the exchange, and each page is read again with the path its host chose. A
page that lacks that path, has no host, or is laid out otherwise follows its own best container. From
the container a page climbs to those around it as long as these hold text of their own as well.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.star import lookup_side
from ..sources.workspace import stage
from .common import utf8

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_CONTAINER = set("article body center div main section table tbody td tr html".split())
_CLOSES_P = set(
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_ITEMS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
#: Elements, and words of class, id or role, that never hold the article.
_APART = set("head script style noscript template title nav footer aside form button select textarea iframe object svg canvas audio video dialog menu".split())
_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe nav navbar navigation menu sidebar aside footer masthead topbar toolbar breadcrumb breadcrumbs comment comments disqus respond "
    "share sharing social related recommended recommendations widget pagination pager login signup contentinfo complementary search".split()
)
_HEADER = {"header", "banner"}
#: Words that say where something is or what it is made of, and not what it is.
_PLACES = set("left right top bottom box area section list item items bar block inner outer wrap wrapper container group row col column panel content main site page global primary secondary".split())
_COMMENT = {"comment", "comments", "disqus", "respond"}
_MODIFIERS = re.compile(r"(?:has|no|with|without|hide|show|is|not)[-_]")
_SPLIT = re.compile(r"[^a-z]+")
DECAY = 0.7  #: of the text in a container that counts for the container around it
NAMED = 1.3  #: weight of the score of an element whose tag says that it holds the article
VOTES = 1000  #: that a page gives a container holding all of its text
WHOLE = 10  #: times the text beside it that an element holds which is not taken for what a word in its names says
FAIR = 0.25  #: share of a page's text below which its host's path may not be what it is laid out by


@dataclass
class _Node:
    tag: str
    container: int  #: the container the element is or is in
    apart: bool
    article: bool
    doubtful: int = -1  #: the nearest element around it that is left out on a word alone


@dataclass
class Page:
    """Containers by number, and the text in them block by block."""

    paths: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [-1])
    named: list[bool] = field(default_factory=lambda: [False])
    edges: list[bool] = field(default_factory=lambda: [True])  #: whether no climb goes on from the container
    outside: list[bool] = field(default_factory=lambda: [True])  #: whether no climb reaches the container
    pieces: list[tuple[int, str, bool]] = field(default_factory=list)  #: container, text, whether in a link

    def votes(self) -> dict[str, int]:
        """The best score of a container of each path, in shares of the text of the page."""
        own = [0.0] * len(self.paths)
        for at, text, link in self.pieces:
            size = len(text.strip())
            own[at] += -size if link else size
        total = sum(max(0.0, x) for x in own)
        if not total:
            return {}
        best: dict[str, int] = {}
        for at in range(len(own) - 1, 0, -1):  # containers come after those they are in
            share = round(VOTES * own[at] / total * (NAMED if self.named[at] else 1))
            if share > best.get(self.paths[at], 0):
                best[self.paths[at]] = share
            if self.parents[at] >= 0:
                own[self.parents[at]] += DECAY * own[at]
        return best

    def _sizes(self) -> tuple[list[int], list[int]]:
        """Characters outside of links less those in links, right in each container and in all of it."""
        own = [0] * len(self.paths)
        for at, text, link in self.pieces:
            size = len(text.strip())
            own[at] += -size if link else size
        whole = list(own)
        for at in range(len(own) - 1, 0, -1):
            whole[self.parents[at]] += whole[at]
        return own, whole

    def share(self, path: str) -> float:
        """How much of the text of the page the containers of ``path`` hold."""
        own, whole = self._sizes()
        total = sum(max(0, x) for x in own)
        return sum(max(0, whole[at]) for at, name in enumerate(self.paths) if name == path) / total if total else 1.0

    def _top(self, start: int, own: list[int], whole: list[int]) -> int:
        """The outermost container that belongs to ``start``.

        That is one around it that holds more text, up to an article or a table cell and never the body.
        Beyond one that holds nothing more, only text right in a container counts, not that of others in it.
        """
        inner: list[list[int]] = [[] for _ in self.paths]
        for at in range(1, len(self.paths)):
            inner[self.parents[at]].append(at)
        top = at = start
        near = True
        while not self.edges[at] and (around := self.parents[at]) > 0 and not self.outside[around]:
            more = own[around] > 0
            if more or (near and any(whole[x] > 0 for x in inner[around] if x != at)):
                top, near = around, True
            else:
                near = False
            at = around
        return top

    def text(self, path: str | None) -> str:
        """The text of the containers of ``path`` and of what belongs to them; None or a path that is not there means all of it."""
        own, whole = self._sizes()
        chosen = [at for at, name in enumerate(self.paths) if name == path]
        if not chosen:
            return " ".join("".join(text for _, text, _ in self.pieces).split())
        best = max(chosen, key=lambda at: (whole[at], -at))
        top = self._top(best, own, whole)
        needed = set(chosen)  # what the climb may not leave out: all around a container of the path
        for at in chosen:
            while at != top and self.parents[at] > 0 and self.parents[at] not in needed:
                at = self.parents[at]
                needed.add(at)
        full = [False] * len(self.paths)  # in a container of the path
        inside = [False] * len(self.paths)
        for at in range(len(self.paths)):
            around = self.parents[at]
            full[at] = self.paths[at] == path or (around >= 0 and full[around])
            # beside the path, containers that are mostly links are left out
            inside[at] = full[at] or at == top or (around >= 0 and inside[around] and (whole[at] > 0 or at in needed))
        return " ".join("".join(p[1] for p in self.pieces if inside[p[0]]).split())


def _named_apart(names: str, words: set[str]) -> bool | None:
    """Whether names that hold one of ``words`` say that an element is apart; None if they may mean something else.

    ``sidebar`` and ``cookie-notice`` say so, and so does any with a word for comments. ``has-sidebar`` is about
    another element. ``social-science`` has a word besides that is not one of place.
    """
    doubt: bool | None = False
    for name in names.split():
        parts = {w for w in _SPLIT.split(name) if w}
        if not parts & words or _MODIFIERS.match(name):
            continue
        if parts & _COMMENT or parts <= words | _PLACES:
            return True
        doubt = None
    return doubt


def _apart(tag: str, attributes: str, article: bool) -> tuple[bool | None, str]:
    """Whether an element is apart from the article, None if only its names may say so, and its classes without numbers."""
    if tag in _APART:
        return True, ""
    if tag == "header" and not article:
        return True, ""
    if not attributes.strip():
        return False, ""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    classes = unescape(found.get("class", "")).lower()
    names = " ".join([classes, found.get("id", "").lower(), found.get("role", "").lower()])
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    away: bool | None = hidden
    if not hidden and tag not in ("html", "body", "article", "main"):
        away = _named_apart(names, _WORDS if article else _WORDS | _HEADER)
    return away, ".".join(sorted({w for w in _SPLIT.split(classes) if w}))


class _Doubts:
    """Elements that are left out on a word alone, by number: what they hold, without links."""

    def __init__(self) -> None:
        self.around: list[int] = []
        self.own: list[int] = []
        self.article: list[int] = []
        self.beside = 0  # text in none of them

    def settled(self) -> frozenset[int]:
        """Those that are not left out: they hold nearly all text of the page, or its article. The largest is asked first."""
        whole, articles = list(self.own), list(self.article)
        inner: list[list[int]] = [[] for _ in whole]
        asked: list[tuple[int, int]] = []
        for n in range(len(whole) - 1, -1, -1):
            if self.around[n] >= 0:
                whole[self.around[n]] += max(0, whole[n])
                articles[self.around[n]] += max(0, articles[n])
                inner[self.around[n]].append(n)
        asked = [(-whole[n], n) for n, around in enumerate(self.around) if around < 0]
        heapq.heapify(asked)
        beside, kept = self.beside, set()
        while asked:
            size, n = heapq.heappop(asked)
            if size < 0 and (-size > WHOLE * beside or articles[n] > beside):
                kept.add(n)
                beside += self.own[n]
                for x in inner[n]:
                    heapq.heappush(asked, (-whole[x], x))
        return frozenset(kept)


def read_page(html: str) -> Page:
    """The containers and texts of a page.

    Elements are left out by their tag, or by a word in their class, id or role. Where such a word may mean something else
    (``_named_apart``) and the element turns out to hold the page (``_Doubts``), the page is read once more with it.
    """
    page, doubts = _read(html, frozenset())
    kept = doubts.settled()
    return _read(html, kept)[0] if kept else page


def _read(html: str, kept: frozenset[int]) -> tuple[Page, _Doubts]:
    """One pass over the tags; elements left open are closed where HTML closes them."""
    page, doubts = Page(), _Doubts()
    stack = [_Node("", 0, False, False)]
    count: Counter[str] = Counter()  # of open elements by tag
    link = 0
    at = 0

    def close(down_to: int) -> None:
        nonlocal link
        while len(stack) > down_to:
            node = stack.pop()
            count[node.tag] -= 1
            link -= node.tag == "a"
            if node.tag not in _INLINE and not node.apart:
                page.pieces.append((node.container, " ", False))

    def add(text: str) -> None:
        if not text:
            return
        node = stack[-1]
        if not node.apart:
            text = unescape(text)
            page.pieces.append((node.container, text, link > 0))
            if not link:
                doubts.beside += len(text.strip())
        elif node.doubtful >= 0:
            size = -len(text.strip()) if link else len(text.strip())
            doubts.own[node.doubtful] += size
            doubts.article[node.doubtful] += size * node.article

    while True:
        found = _TOKEN.search(html, at)
        add(html[at : found.start()] if found else html[at:])
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            if not count[tag]:
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
                if tag in _INLINE and stack[depth].tag in _CONTAINER:
                    break
            continue
        if (tag in _CLOSES_P and count["p"]) or (tag in _ITEMS and (count["p"] or any(count[t] for t in (tag, "dt", "dd")))):
            stops = _ITEMS.get(tag, set())
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = stack[depth].tag
                if open_tag == "p" or open_tag == tag in _ITEMS or (tag in ("dt", "dd") and open_tag in ("dt", "dd")):
                    close(depth)
                    break
                if open_tag in _CONTAINER or open_tag in stops or open_tag in ("ul", "ol", "dl"):
                    break
        around = stack[-1]
        if tag not in _INLINE and not around.apart:
            page.pieces.append((around.container, " ", False))
        if tag in _VOID:
            continue
        away, classes = _apart(tag, found[3], around.article)
        container, doubtful = around.container, around.doubtful
        if around.apart and doubtful < 0:
            away = True
        elif away is None:
            number = len(doubts.own)
            doubts.around.append(doubtful)
            doubts.own.append(0)
            doubts.article.append(0)
            away = number not in kept
            doubtful = number if away else doubtful
        elif away:
            doubtful = -1
        if tag in _CONTAINER and not (away or around.apart):
            name = f"{page.paths[container]}>{tag}.{classes}"
            page.paths.append(blake2b(name.encode(), digest_size=8).hexdigest())
            page.parents.append(container)
            page.named.append(tag in ("article", "main"))
            page.edges.append(tag in ("article", "main", "td"))
            page.outside.append(tag in ("html", "body"))
            container = len(page.paths) - 1
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(html, at)
            at = end.end() if end else len(html)
            continue
        stack.append(_Node(tag, container, away or around.apart, around.article or tag in ("article", "main"), doubtful))
        count[tag] += 1
        link += tag == "a"
    close(1)
    return page, doubts


def best_path(page: Page) -> str | None:
    votes = page.votes()
    return max(sorted(votes), key=votes.__getitem__) if votes else None


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total: dict[tuple[str, str], list[int]] = {}
        for host, raw in zip(batch.column("host").to_pylist(), utf8(batch.column("html")), strict=True):
            page = read_page((raw or b"").decode())
            votes, best = page.votes(), best_path(page)
            for path in set(page.paths[1:]):
                entry = total.setdefault((host, path), [0, 0, 0])
                entry[0] += votes.get(path, 0)
                entry[1] += path == best
                entry[2] += 1
        counts = [pa.array([entry[k] for entry in total.values()], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in total], pa.string()), pa.array([p for _, p in total], pa.string()), *counts], ["host", "path", "votes", "wins", "pages"]
        )


def path_of(page: Page, path: str | None, boxes: list[str] | None) -> str | None:
    """The path to read a page by: that of its host, unless the page is laid out otherwise.

    That is so if the path is not there, or holds little of the page's text while the page's own best
    container is none of the ``boxes``, which lose to another container on most pages that have them.
    """
    own = best_path(page)
    if path not in page.paths[1:]:
        return own
    return own if own is not None and own not in (boxes or ()) and page.share(path) < FAIR else path


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for raw, path, boxes in zip(utf8(batch.column("html")), batch.column("path").to_pylist(), batch.column("boxes").to_pylist(), strict=True):
            page = read_page((raw or b"").decode())
            texts.append(page.text(path_of(page, path, boxes)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id, url, html``).

    A NULL or empty page has an empty text. A page whose url is NULL or names no host follows its own
    best container. Equal votes go to the first path by name. Repeated rows vote and come back one by
    one; other columns are not read. An empty table gives an empty result.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    hosted = pages.withColumn("host", F.lower(F.try_parse_url("url", F.lit("HOST"))))
    votes = hosted.where("host IS NOT NULL").select("host", "html").mapInArrow(_vote, "host string, path string, votes long, wins long, pages long")
    votes = votes.groupBy("host", "path").agg(*[F.sum(c).alias(c) for c in ("votes", "wins", "pages")])
    voted = F.when(F.col("votes") > 0, F.col("path"))
    box = F.when((F.col("wins") > 0) & (2 * F.col("wins") < F.col("pages")), F.col("path"))
    chosen = votes.groupBy("host").agg(
        F.min_by(voted, F.struct(-F.col("votes"), "path")).alias("path"),
        F.collect_list(box).alias("boxes"),  # of the classes of a host, as others are on one page only
    )
    chosen = stage(chosen, "chosen")
    # sent to the pages while its measured size allows it: a host with a third of all pages then stays
    # where it is; above that Spark joins by host and splits hot hosts
    found = hosted.join(lookup_side(chosen), "host", "left").select("page_id", "url", "html", "path", "boxes")
    return found.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
