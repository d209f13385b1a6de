"""HTML extraction by consensus host paths.

Pass 1 scores the containers of each page, goes from the best one out to the article that it is part of, and names
the generalised path of tags and classes.  Spark counts these votes per host, pre-aggregated, so a hot host moves few rows.
Pass 2 extracts every page again from the elements on its host's winning path, or from its
own best container where the page has none.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import blocks, spread_join, stage

# Fixed names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
CONTAINERS = frozenset("html body div section article main td center layer".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside blockquote caption dd details dialog dir dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li menu nav ol optgroup option p pre search summary table tbody tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "head nav footer aside form script style noscript template iframe svg select button textarea title menu dialog object audio video map datalist noembed noframes xmp".split()
)
#: What an open element of the key ends when a start tag of the value comes.
ENDS = {
    "p": BLOCKS - {"option", "optgroup"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option", "optgroup"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "head": frozenset(["body"]) | BLOCKS,
}
#: Words in a class, id or role that mark what is not the article.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored promo promoted promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social menu menus nav navbar navigation breadcrumb breadcrumbs sidebar sidebars sidenav footer masthead toolbar comment comments commentlist disqus respond replies related recommended recommendations "
    "widget widgets pagination pager skip contentinfo complementary search".split()
)
#: Those that a wrapper of the article may have too, for what else it holds; the others name its kind.
WRAPPING = frozenset("banner menu menus nav navbar navigation breadcrumb breadcrumbs sidebar sidebars sidenav footer header masthead toolbar widget widgets search".split())
#: What comes after one of these in a class is only said to be there, or not to be.
MODIFIERS = frozenset("has have with without no not hide hides layout".split())
#: Unlinked characters from which a block is a paragraph.
PARAGRAPH = 80
#: Words that say that an element is the article, or belongs to it.
ARTICLE = frozenset("article articlebody content entry main post story text body".split())

_TAG = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=>"'/]+)""")
_WORD = re.compile(r"[a-z]+")
_NUMBER = re.compile(r"[0-9]+")


@dataclass
class Block:
    """A run of text between block borders, in its innermost container."""

    text: str
    linked: int
    container: int
    doubt: int = -1


@dataclass
class Page:
    """Blocks, and the containers: each one's parent (before it), depth, last step of its path, tag, and whether it is named as the article."""

    blocks: list[Block] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    step: list[str] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    named: list[bool] = field(default_factory=list)

    def path(self, i: int) -> str:
        """The steps from the page to a container; only a winner's path is ever written out."""
        out = []
        while i >= 0:
            out.append(self.step[i])
            i = self.parent[i]
        return "/".join(reversed(out))

    def on(self, path: str | None) -> set[int]:
        """All containers on that path."""
        steps = path.split("/") if path is not None else []
        along = [False] * len(self.step)  # on a beginning of the path
        for i, (up, d, own) in enumerate(zip(self.parent, self.depth, self.step)):
            along[i] = d < len(steps) and own == steps[d] and (up < 0 or along[up])
        return {i for i, d in enumerate(self.depth) if along[i] and d == len(steps) - 1}


def _attributes(raw: str) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)} if raw else {}


def _step(tag: str, attributes: dict[str, str]) -> str:
    """The tag and its classes, digits made alike: items of a list and numbered pages share it."""
    classes = sorted({_NUMBER.sub("#", c.lower()).replace("/", "|") for c in attributes.get("class", "").split()})
    return ".".join([tag.replace("/", "|"), *classes])


def _unwanted(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in DROPPED or tag == "header" and not in_article:
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    return False


def _boilerplate(attributes: dict[str, str], in_article: bool) -> set[str]:
    """The words that mark an element as boilerplate; none if a class, the id or the role of its own says article.

    In a name like post-comments both kinds of words mark one thing, which is boilerplate; a role is not outvoted.
    """
    found, saved = set(), False
    role = set(_WORD.findall(attributes.get("role", "").lower()))
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        words = _WORD.findall(name)
        first = next((k for k, w in enumerate(words) if w in MODIFIERS), len(words))
        own = set(words[:first])
        marks = own & BOILERPLATE | (own & {"header"} if not in_article and not own & ARTICLE else set())
        found |= marks
        saved = saved or not marks and bool(own & ARTICLE)
    return role & BOILERPLATE | (set() if saved or role & ARTICLE else found)


def parse(text: str) -> Page:
    """Blocks and containers of a page, without what is never the article.  Linear in the page.

    An element that only its words mark is in doubt until the page is read: it stays if it holds the article.
    """
    page = Page()
    stack: list[tuple[str, int, bool, bool, int]] = []  # tag, container before it, dropped, link, doubt before it
    doubts: list[list] = []  # outer doubt, whether its words may mark a wrapper, whether it holds an article or main
    opened: Counter[str] = Counter()
    last = {'"': text.rfind('"'), "'": text.rfind("'")}
    buffer: list[str] = []
    state = {"container": -1, "dropped": 0, "linked": 0, "links": 0, "doubt": -1}

    steps: dict[str, str] = {}  # equal steps are one string

    def container(tag: str, step: str, named: bool) -> None:
        up = state["container"]
        page.parent.append(up)
        page.depth.append(page.depth[up] + 1 if up >= 0 else 0)
        page.step.append(steps.setdefault(step, step))
        page.tag.append(tag)
        page.named.append(named)
        state["container"] = len(page.parent) - 1

    def flush() -> None:
        if buffer:
            own = " ".join(html.unescape("".join(buffer)).split())
            if own:
                page.blocks.append(Block(own, min(state["linked"], len(own)), state["container"], state["doubt"]))
            buffer.clear()
        state["linked"] = 0

    def close() -> None:
        tag, before, dropped, link, doubt = stack.pop()
        opened[tag] -= 1
        if (tag in BLOCKS or doubt != state["doubt"]) and not state["dropped"]:
            flush()
        state["doubt"] = doubt
        state["container"] = before
        state["dropped"] -= dropped
        state["links"] -= link

    def said(piece: str) -> None:
        if piece and not state["dropped"]:
            buffer.append(piece)
            if state["links"]:
                state["linked"] += len(piece)

    container("", "", False)
    at, n = 0, len(text)
    while at < n:
        m = _TAG.search(text, at)
        if not m:
            said(text[at:])
            break
        said(text[at : m.start()])
        if text.startswith("<!--", m.start()):
            end = text.find("-->", m.end())
            at = n if end < 0 else end + 3
            continue
        end, seen = m.end(), m.end()
        while True:  # the first > outside quotes; a quote that never closes is no quote
            end = text.find(">", seen)
            if end < 0:
                end = n
                break
            inner = text[seen:end]
            q = min((inner.find(c) for c in "\"'" if c in inner), default=-1)
            if q < 0 or last[inner[q]] <= seen + q:
                break
            shut = text.find(inner[q], seen + q + 1)
            if shut < end and shut >= 0:
                seen = shut + 1
                continue
            if m[2] is None or text[seen + q - 1] not in "= \t\n\r\f":
                break
            seen = shut + 1
        raw, at = text[m.end() : end], end + 1
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not opened["p"] and not state["dropped"]:
                flush()
            if opened[tag]:
                while stack[-1][0] != tag:
                    close()
                close()
            continue
        while stack and tag in ENDS.get(stack[-1][0], ()):
            close()
        if tag in ENDS["p"] and opened["p"]:  # an open p ends with what stands open inside it
            while stack[-1][0] != "p":
                close()
            close()
        attributes = _attributes(raw)
        if tag in BLOCKS and not state["dropped"]:
            flush()
        if tag in VOID or raw.endswith("/") and tag not in BLOCKS:
            if tag in ("br", "img", "wbr", "hr") and tag != "wbr":
                said(" ")
            continue
        if tag in RAW:
            shut = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|$)", re.I).search(text, at)
            if not shut:
                at = n
            else:
                at = text.find(">", shut.end())
                at = n if at < 0 else at + 1
            continue
        in_article = bool(opened["article"] or opened["main"])
        dropped = _unwanted(tag, attributes, in_article)
        if dropped and not state["dropped"]:
            flush()
        before, doubt = state["container"], state["doubt"]
        if not dropped and not state["dropped"] and tag not in ("html", "body"):
            marks = _boilerplate(attributes, in_article) if attributes else None
            if tag in ("article", "main"):
                k = doubt if not marks else -1
                while k >= 0 and not doubts[k][2]:
                    doubts[k][2] = True
                    k = doubts[k][0]
            elif marks:
                flush()
                doubts.append([doubt, marks <= WRAPPING, False])
                state["doubt"] = len(doubts) - 1
        if tag in CONTAINERS and not state["dropped"] and not dropped:
            words = set(_WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')} {attributes.get('role', '')}".lower()))
            container(tag, _step(tag, attributes), tag in ("article", "main") or tag != "body" and bool(words & ARTICLE))
        stack.append((tag, before, dropped, tag == "a", doubt))
        opened[tag] += 1
        state["dropped"] += dropped
        state["links"] += tag == "a"
    while stack:
        close()
    flush()
    if doubts:
        kept = _kept(page, doubts)
        page.blocks = [b for b in page.blocks if b.doubt < 0 or kept[b.doubt]]
    return page


def _kept(page: Page, doubts: list[list]) -> list[bool]:
    """Whether each element in doubt stays, outer ones first; one inside a dropped one goes with it.

    One with words that a wrapper may have stays if it holds an article or main with more unlinked text than is certain,
    or most of the page's unlinked text; another only if no paragraph is certain as well.
    """
    own, paragraphs = [0] * (len(doubts) + 1), [False] * (len(doubts) + 1)  # the last: outside all
    for b in page.blocks:
        n = max(0, len(b.text) - 2 * b.linked)
        own[b.doubt] += n
        paragraphs[b.doubt] |= n >= PARAGRAPH
    inside = list(own)
    for k in range(len(doubts) - 1, -1, -1):
        inside[doubts[k][0]] += inside[k]
    kept = [False] * len(doubts) + [True]
    for k, (outer, wrapping, holds) in enumerate(doubts):
        large = 2 * inside[k] > inside[-1]
        kept[k] = kept[outer] and (large or holds and inside[k] > own[outer]) and (wrapping or not paragraphs[outer])
        if kept[k]:  # what is certain inside it
            own[k] += own[outer]
            paragraphs[k] |= paragraphs[outer]
    return kept


def scores(page: Page) -> list[int]:
    """For each container its characters outside links, a bit less for each level that they lie deeper."""
    out = [0] * len(page.parent)
    for b in page.blocks:
        out[b.container] += 100 * max(0, len(b.text) - 2 * b.linked)
    for i in range(len(out) - 1, 0, -1):
        if page.parent[i] >= 0:
            out[page.parent[i]] += out[i] * 95 // 100
    return [s * 5 // 4 if named else s for s, named in zip(out, page.named)]


def best(page: Page) -> int:
    """The container with the highest score, the outermost of equal ones; then out to the article that it is part of."""
    s = scores(page)
    return _climbed(page, max(range(len(s)), key=lambda i: (s[i], -i)))


def _climbed(page: Page, inner: int) -> int:
    """The article around the container, then the highest ancestor that adds text, not mostly links: up to main, if
    there is one, or from outside any article to the page."""
    sizes, linked = [0] * len(page.parent), [0] * len(page.parent)
    for b in page.blocks:
        sizes[b.container] += len(b.text)
        linked[b.container] += b.linked
    for i in range(len(sizes) - 1, 0, -1):
        if page.parent[i] >= 0:
            sizes[page.parent[i]] += sizes[i]
            linked[page.parent[i]] += linked[i]
    up, k = [], inner
    while k >= 0:
        up.append(k)
        k = page.parent[k]
    tags = [page.tag[k] for k in up]
    at = tags.index("article") if "article" in tags else 0
    last = tags.index("main", at) if "main" in tags[at:] else at if "article" in tags else len(up) - 1
    out = up[at]
    for k in up[at + 1 : last + 1]:
        more = sizes[k] - sizes[out]
        if more and 2 * (linked[k] - linked[out]) < more:
            out = k
    return out


def extract(page: Page, path: str | None) -> str:
    """The blocks inside all containers on ``path``, else inside the best one."""
    for choose in (lambda: page.on(path), lambda: {best(page)}):
        roots, inside = choose(), [False] * len(page.parent)
        for i, up in enumerate(page.parent):
            inside[i] = i in roots or up >= 0 and inside[up]
        text = "\n".join(b.text for b in page.blocks if inside[b.container])
        if text:
            return text
    return ""


def host_of(url: str) -> Column:
    """The host of a column of addresses, in lower case; '' for null and odd ones."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)).alias("host")


#: Most bytes of winning paths that go out to every executor; beyond it pages are joined with them by host.
BROADCAST_BYTES = 8 << 20


def winning_paths(pages: DataFrame) -> DataFrame:
    """host, path: the path that most of the host's pages have as their best container's (tie: the
    higher score together, then the later path by name)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0])
            hosts = batch.column("host").to_pylist()
            for first, texts in blocks(batch, "html"):
                for host, t in zip(hosts[first:], texts):
                    page = parse(t)
                    i = best(page)
                    if score := scores(page)[i]:
                        v = votes[host, page.path(i)]
                        v[0] += 1
                        v[1] += score
            rows = [(*k, *v) for k, v in votes.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["host", "path", "votes", "score"])

    cast = pages.select(host_of("url"), "html").mapInArrow(run, "host string, path string, votes long, score long")
    summed = cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("score").alias("score"))
    return summed.groupBy("host").agg(F.max_by("path", F.struct("votes", "score", "path")).alias("path"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html, ...).

    A null or empty html has the empty text; a null or odd url counts as host ''.  Repeated rows give repeated
    rows; other columns are not read; an empty table gives no rows.
    """
    spark = pages.sparkSession
    winners, _ = stage(winning_paths(pages), "host-paths")
    size = winners.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 64).alias("n")).first()["n"] or 0
    own = pages.select("page_id", "url", "html", host_of("url"))
    paths = None
    if size <= BROADCAST_BYTES:
        paths = spark.sparkContext.broadcast({r["host"]: r["path"] for r in winners.collect()})
        own = own.withColumn("path", F.lit(None).cast("string"))
    else:  # the same paths, joined; a hot host's pages are dealt over several tasks
        sizes = own.groupBy("host").agg(F.count("*").alias("n"))
        own = spread_join(own, winners.join(sizes, "host"), "host", F.xxhash64("url", "page_id"), own.count(), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, joined = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            for first, texts in blocks(batch, "html"):
                out = []
                for k, t in enumerate(texts, first):
                    out.append(extract(parse(t), paths.value.get(hosts[k]) if paths else joined[k]))
                rows = slice(first, first + len(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id")[rows].cast(pa.int64()), batch.column("url")[rows].cast(pa.string()), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return own.select("page_id", "url", "html", "host", "path").mapInArrow(run, "page_id long, url string, text string, n_chars long")
