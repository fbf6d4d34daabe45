"""Main text of web pages by consensus paths of each host."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_slices

#: Rows of (host, path) that may be broadcast, and their characters; beyond, the join is a shuffle.
BROADCAST_ROWS, BROADCAST_CHARS = 200_000, 16_000_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
#: Elements whose content is never text of an article.
DROPPED = frozenset(
    "script style noscript template iframe object embed svg math canvas audio video map nav aside footer button select option textarea input label fieldset dialog menu head title noembed noframes".split()
)
#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table caption tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that the start of a key's element ends.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"}}
_SCOPE = frozenset("ul ol dl table html body article section main div td th".split())
#: Words of class, id and role names that mark what isn't the article.
JUNK = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer "
    "masthead topbar toolbar header cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments disqus respond reply replies "
    "share sharing social related recommended recommendations pagination pager widget skip search tags complementary contentinfo".split()
)
#: Those of them under which whole articles are put only when they hold nearly all of the page.
THREAD = frozenset("comment comments disqus respond reply replies".split())
#: First words of names that say what a layout has or lacks.
_LAYOUT = frozenset("has no not with without".split())
#: Elements whose text is prose, of whatever length; elsewhere it is from so many characters on.
PROSE, SENTENCE = frozenset("p li dd dt pre blockquote td th figcaption caption h1 h2 h3 h4 h5 h6".split()), 80
#: Elements of a path: the innermost ones of deeper containers.
PATH = 64
#: Share of its text by which a host's path may fall short of a page's own best container.
CLOSE = 0.9
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|[=\"'])*+)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[a-z]+|\d+")
_ARTICLE = re.compile(r"\b(?:article|main|post|entry|story|content)\b")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass(slots=True)
class Node:
    """An open element: whether it is in an article, whether its content is dropped, and where its blocks begin.

    ``hard``: dropped by more than its names; ``doubt``: its number among those dropped only by them.
    """

    tag: str
    inside: bool
    dropped: bool
    container: int
    hard: bool = False
    doubt: int = -1


@dataclass(slots=True)
class Container:
    """What stands directly or deeper in an element: characters of text, of links, of headings, of prose, and paragraphs.

    ``name`` is the generalised one of its element.
    """

    name: str
    parent: int
    depth: int
    chars: int = 0
    link_chars: int = 0
    heading_chars: int = 0
    prose_chars: int = 0
    paragraphs: int = 0
    first: int = 0
    after: int = 0


@dataclass(slots=True)
class Doubt:
    """An element that only its names (or ``form``) mark: characters outside links, articles and first headings in it.

    ``outer``: none of the same name is around it.
    """

    name: str
    outer: bool
    thread: bool
    chars: int
    articles: int
    titles: int


@dataclass
class Page:
    """Blocks of text in page order and the containers around them.

    ``chars``: characters outside links, of what isn't hard dropped; ``left``: those that aren't dropped at all.
    """

    blocks: list[str] = field(default_factory=list)
    containers: list[Container] = field(default_factory=list)
    doubts: list[Doubt] = field(default_factory=list)
    chars: int = 0
    left: int = 0
    titles: int = 0

    def path(self, at: int) -> str:
        """Generalised tag-class path of a container: of up to ``PATH`` containers, the innermost last."""
        names = []
        while at > 0 and len(names) < PATH:
            names.append(self.containers[at].name)
            at = self.containers[at].parent
        return ">".join(reversed(names))


def general_name(tag: str, attributes: str) -> tuple[str, set[str], bool]:
    """(tag with the words of its class, digits left out; words that mark it as no part of an article; whether it is hidden)."""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return tag, set(), False
    classes, junk, hidden = [], set(), False
    for m in _NAMES.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" and tag not in ("article", "main", "body"):
            hidden = True
        elif name == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        else:
            for one in value.split():
                words = [w for w in _WORDS.findall(_CAMEL.sub(" ", one).lower()) if not w.isdigit()]
                if name == "class" and words:
                    classes.append("-".join(words))
                if words and words[0] not in _LAYOUT and tag not in ("html", "body", "article", "main"):
                    junk |= JUNK.intersection(words)
    return tag + "".join("." + c for c in sorted(set(classes))), junk, hidden


def parse(html: str) -> Page:
    """Blocks of the page's text without dropped elements, and the containers that they stand in.

    Names are a mark, no proof: the page is parsed again with those marked elements (and forms) that hold most of its
    text outside links (elements of one name together), its only article with a quarter of that text, or its only
    first heading, and without any marks where a tenth or less of the text would be left. Elements named for comments
    must hold nine tenths.
    """
    page = _parse(html)
    if not page.doubts:
        return page
    articles = any(c.chars and c.name.rsplit(">", 1)[-1].split(".")[0] in ("article", "main") for c in page.containers)
    together: dict[str, int] = {}
    for d in page.doubts:
        if d.outer:
            together[d.name] = together.get(d.name, 0) + d.chars
    kept = set()
    for i, d in enumerate(page.doubts):
        part, all_ = (n / page.chars if page.chars else 0.0 for n in (d.chars, together[d.name]))
        if all_ >= 0.9 or not d.thread and (not articles and (all_ > 0.5 or d.articles and part >= 0.25) or d.titles and not page.titles):
            kept.add(i)
    if kept:
        page = _parse(html, kept)
    return _parse(html, None) if page.chars and page.left * 10 <= page.chars or not page.blocks else page


def _parse(html: str, kept: set[int] | None = frozenset()) -> Page:
    """One pass; of the elements that only names mark, those with the numbers ``kept`` stay, all for None.

    Lenient: end tags without a start are skipped, open elements end with the page. Character references are decoded,
    white space inside a block (line breaks too) becomes one space, blocks without text are left out.
    """
    page = Page()
    page.containers.append(Container("", -1, 0))
    stack = [Node("", False, False, 0)]
    is_open: Counter[str] = Counter()
    pieces: list[str] = []
    anchors = 0
    link_part = 0
    in_paragraph = False
    doubts, articles, titles, around = page.doubts, 0, 0, Counter()

    def flush() -> None:
        nonlocal link_part
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                at, heading = stack[-1].container, stack[-1].tag in HEADINGS
                prose = len(text) if in_paragraph or stack[-1].tag in PROSE or len(text) >= SENTENCE else 0
                links, link_part = min(link_part, len(text)), 0
                page.blocks.append(text)
                c = page.containers[at]  # what is around it gets its sums at the end
                c.chars += len(text)
                c.link_chars += links
                c.heading_chars += len(text) if heading else 0
                c.prose_chars += prose
                c.paragraphs += in_paragraph
                c.after = len(page.blocks)
        link_part = 0

    def text(raw: str) -> None:
        nonlocal link_part
        top = stack[-1]
        if raw and not top.hard:
            value = unescape(raw) if "&" in raw else raw
            size = len(value.strip())
            if not anchors:
                page.chars += size
                page.left += 0 if top.dropped else size
            if not top.dropped:
                pieces.append(value)
                if anchors:
                    link_part += size

    def doubt(name: str, words: set[str]) -> int:
        around[name] += 1
        doubts.append(Doubt(name, around[name] == 1, not THREAD.isdisjoint(words), -page.chars, -articles, -titles))
        return len(doubts) - 1

    def left(node: Node) -> None:
        is_open[node.tag] -= 1
        if node.doubt >= 0:
            d = doubts[node.doubt]
            around[d.name] -= 1
            d.chars, d.articles, d.titles = d.chars + page.chars, d.articles + articles, d.titles + titles

    def close(to: int) -> None:
        nonlocal in_paragraph
        flush()
        while len(stack) > to:
            node = stack.pop()
            left(node)
            if node.tag == "p":
                in_paragraph = False

    at, n = 0, len(html)
    while at < n:
        start = html.find("<", at)
        if start < 0:
            text(html[at:])
            break
        m = _TOKEN.match(html, start)
        if not m:
            text(html[at : start + 1])
            at = start + 1
            continue
        if start > at:
            text(html[at:start])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                anchors = max(0, anchors - 1)
            elif tag in BLOCK or tag in DROPPED:
                if is_open[tag]:
                    close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
                elif tag in BLOCK and not stack[-1].dropped:
                    flush()
            elif stack[-1].tag == tag:
                left(stack.pop())  # a dropped inline element; the block around it goes on
            continue
        if tag in RAW:  # its content has no tags
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag == "hr":
            flush()
        if tag in VOID:
            continue
        if tag == "a":
            anchors += 1
            continue
        if tag not in BLOCK and tag not in DROPPED:
            name, junk, hidden = general_name(tag, m[3])
            top = stack[-1]
            marked = bool(junk) and kept is not None
            if not (marked or hidden or top.tag == tag and (top.dropped or top.doubt >= 0)) or m[3].rstrip().endswith("/"):
                continue  # only an inline element that is dropped, or one of its name in it, needs its end
            number = doubt(name, junk) if marked and not hidden and not top.hard else -1
            gone = top.dropped or hidden or marked and number not in kept
            is_open[tag] += 1
            stack.append(Node(tag, top.inside, gone, top.container, top.hard or hidden, number))
            continue
        # a block ends an open paragraph, and a list item or cell the one before it
        ends = {"p"} | _CLOSES.get(tag, set())
        if any(is_open[x] for x in ends):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    close(i)
                    if stack[-1].tag not in ends:
                        break
                elif stack[i].tag in _SCOPE:
                    break
        flush()
        anchors = 0
        name, junk, hidden = general_name(tag, m[3])
        top = stack[-1]
        heading = tag in HEADINGS
        out = not (heading and top.inside and top.tag == "header")
        hard = top.hard and out or tag in DROPPED or hidden or tag == "header"
        marked = (bool(junk) or tag == "form") and kept is not None
        number = doubt(name, junk) if marked and not hard else -1
        dropped = top.dropped and out or hard or marked and number not in kept
        if not hard:
            articles += tag in ("article", "main")
            titles += tag == "h1"
            page.titles += tag == "h1" and not dropped
        container = top.container
        if not dropped and not heading and tag not in ("p", "hr"):
            page.containers.append(Container(name, top.container, len(stack), first=len(page.blocks), after=len(page.blocks)))
            container = len(page.containers) - 1
        is_open[tag] += 1
        stack.append(Node(tag, top.inside or bool(_ARTICLE.search(name)), dropped, container, hard, number))
        in_paragraph = in_paragraph or tag == "p" and not dropped
    flush()
    while stack:
        left(stack.pop())
    for c in reversed(page.containers[1:]):
        up = page.containers[c.parent]
        up.chars += c.chars
        up.link_chars += c.link_chars
        up.heading_chars += c.heading_chars
        up.prose_chars += c.prose_chars
        up.paragraphs += c.paragraphs
        up.after = max(up.after, c.after)
    return page


def scores(page: Page) -> list[tuple[str, float]]:
    """(path, score) of the containers that hold text, the best first.

    Text outside links counts, less the more of it there is in links, more with paragraphs and, a little, with depth;
    ``article`` and ``main`` count three times, ``body`` half. A container whose parent adds only headings, or text of
    which at most a quarter is in links and at least half is prose, stands for that parent, so that an article keeps its
    title and all its parts. For ``body`` to stand for one, all that it adds must be prose; one inside of ``article`` or
    ``main`` stays inside unless there are only headings outside.
    """
    best: dict[int, float] = {}
    every = page.containers
    stands: list[int] = [0] * len(every)  # for which container each one stands, outer ones first
    larger: list[int] = [0] * len(every)  # the nearest container around it that has more text
    for i, c in enumerate(every[1:], 1):
        if not c.chars:
            continue
        own = (c.chars - c.link_chars) * (1.0 - c.link_chars / c.chars) * (1.0 + min(c.paragraphs, 20) / 20)
        if c.name.startswith(("article", "main")):
            own *= 3.0
        elif c.name in ("body", "html"):
            own *= 0.5
        own *= 1.0 + 0.02 * min(c.depth, 10)
        at = larger[i] = c.parent if every[c.parent].chars > c.chars else larger[c.parent]
        stands[i] = i
        if at > 0:
            up = every[at]
            whole = up.name in ("body", "html")
            more, links, prose = up.chars - c.chars, up.link_chars - c.link_chars, up.prose_chars - c.prose_chars
            titles = more == up.heading_chars - c.heading_chars
            rest = links * 4 <= more and prose * 2 >= more and not c.name.startswith(("article", "main"))
            if not (whole and (not rest or titles or prose != more) or not (titles or rest)):
                stands[i] = stands[at]
        best[stands[i]] = best.get(stands[i], 0.0) + own
    by_path: dict[str, float] = {}
    for i, own in best.items():
        path = page.path(i)
        by_path[path] = by_path.get(path, 0.0) + own
    return sorted(by_path.items(), key=lambda x: (-x[1], x[0]))


def blocks_at(page: Page, path: str | None) -> set[int]:
    """Numbers of the blocks in the containers with the path."""
    wanted: set[int] = set()
    if path:
        last, after = path.rsplit(">", 1)[-1], 0
        for i, c in enumerate(page.containers):  # in the order of their starts
            if c.name == last and c.after > after and page.path(i) == path:
                wanted.update(range(max(after, c.first), c.after))
                after = c.after
    return wanted


def text_at(page: Page, path: str | None) -> str | None:
    """Blocks of the containers with the path, in page order, joined by newlines; None if the page has none with text."""
    wanted = blocks_at(page, path)
    return "\n".join(page.blocks[i] for i in sorted(wanted)) if wanted else None


def main_text(page: Page, path: str | None) -> str:
    """The text at the host's path if that holds nearly all of the page's own best container, else at the latter."""
    theirs, ranked = blocks_at(page, path), scores(page)
    own = blocks_at(page, ranked[0][0]) if ranked else set()
    if own and sum(len(page.blocks[i]) for i in own & theirs) < CLOSE * sum(len(page.blocks[i]) for i in own):
        theirs = own
    return "\n".join(page.blocks[i] for i in sorted(theirs)) if theirs else "\n".join(page.blocks)


def host_of(url: str | None) -> str:
    """Lower-case host of an address without port and without ``www.``; empty for none."""
    m = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return (m[1].lower().removeprefix("www.") if m else "")


def _columns(batches: Iterable[pa.RecordBatch], more: int) -> Iterator[tuple[list, ...]]:
    for batch in batches:
        rows = list(range(batch.num_rows))
        html = [x or "" for x in batch.column(0).to_pylist()]
        rest = [batch.column(i).to_pylist() for i in range(1, more + 1)]
        for at, texts in text_slices(rows, html):
            yield texts, *([c[i] for i in at] for c in rest)


def _votes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for texts, urls in _columns(batches, 1):
        votes: dict[tuple[str, str], float] = {}
        for html, url in zip(texts, urls, strict=True):
            ranked, host = scores(parse(html)), host_of(url)
            for path, value in ranked:
                if value > 0.0:
                    votes[host, path] = votes.get((host, path), 0.0) + value / ranked[0][1]
        rows = [(*k, v) for k, v in votes.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.float64()))], ["host", "path", "vote"])


def winning_paths(pages: DataFrame) -> DataFrame:
    """``host, path``: the generalised tag-class path that the pages of a host give the most votes.

    A page votes for all its containers with text outside links, each with its score over its best one's. Votes are added
    up in each task and by host and path before they meet, so that a host with most of the pages costs no more than its
    different paths. Ties go to the shorter path, then to the greater one.
    """
    votes = pages.select(F.col("html").cast("string"), F.col("url").cast("string")).mapInArrow(_votes, "host string, path string, vote double")
    tallied = votes.groupBy("host", "path").agg(F.sum("vote").alias("votes"))
    return tallied.groupBy("host").agg(F.max_by("path", F.struct(F.round("votes", 6), F.expr("-length(path)"), "path")).alias("path"))


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for texts, page_ids, urls, paths in _columns(batches, 3):
        out = [main_text(parse(html), path) for html, path in zip(texts, paths, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(page_ids, pa.int64()), pa.array(urls, pa.string()), pa.array(out, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of every whole page, re-extracted at its host's winning path.

    A page whose path misses more than a tenth of the text of its own best container takes the latter; one without containers takes all its blocks. Null or empty html gives an empty text; a null url is a host
    of its own name; null ids and repeated rows stay; other columns aren't read.

    The winners are broadcast only while they are few and short (``BROADCAST_ROWS``, ``BROADCAST_CHARS``); beyond that
    they meet the pages in a shuffled join, whose large hosts Spark splits.
    """
    winners = materialise(winning_paths(pages))
    size = winners.agg(F.count("*"), F.coalesce(F.sum(F.length("path") + F.length("host")), F.lit(0))).first()
    small = size[0] <= BROADCAST_ROWS and size[1] <= BROADCAST_CHARS
    host = F.coalesce(F.regexp_replace(F.lower(F.regexp_extract("url", r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), r"^www\.", ""), F.lit(""))
    rows = pages.select(F.col("html").cast("string").alias("html"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).withColumn("host", host)
    joined = rows.join(F.broadcast(winners) if small else winners, "host", "left").select("html", "page_id", "url", "path")
    found = joined.mapInArrow(_extract, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
