"""Main text of web pages by site style trees.

Pages are read into blocks of text, each with the path of elements (and their classes) above it. The pages of a
host are merged by path. At each path the entropy of its contents, and that of the sequences of children its
elements have, is taken over the host's different pages, as a share of the largest possible: 0 when all
pages agree, 1 when no two do (or only one page has it). A path whose contents and presentation both
stay under LEAST is of low importance and its branch is removed from every page, inside of an ``article`` or
``main`` as well as outside. Headings of an article may repeat at a site, so they are not judged, and no article loses
most of its text: near copies of one are no template. Pages are different if their articles are, whatever adverts and
menus they have around them; those without an article, if their text is.

A site with few pages tells little, so elements whose tag, role or class names what they are (ROLES) have no
importance at any site.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.shared import prepare, written

#: Importance under which a path is removed, and pages of a host that a path needs to be judged.
LEAST = 0.3
LEAST_PAGES = 4

#: Elements without text of the page, those that hold no content of their own, and words for the latter.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"}
HIDDEN = {"script", "style", "title", "template", "noscript", "iframe", "object", "embed", "svg", "canvas", "audio", "video", "noembed", "noframes", "head"}
ROLE_TAGS = {"nav", "footer", "aside", "form", "button", "select", "option", "textarea", "input", "label", "dialog", "menu"}
ROLES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "toolbar", "topbar", "pagination", "pager",
    "sidebar", "aside", "complementary", "related", "recommended", "widget", "widgets",
    "header", "masthead", "footer", "contentinfo", "copyright",
    "notice", "notices", "alert", "cookie", "cookies", "consent", "gdpr", "popup", "modal", "overlay", "dialog",
    "comment", "comments", "reply", "replies", "respond", "discussion", "disqus",
    "share", "sharing", "social", "subscribe", "newsletter", "signup", "login", "search", "form",
}
#: Roles that a large element may well have: a discussion is often longer than its article.
TALK = {"comment", "comments", "reply", "replies", "respond", "discussion", "disqus"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "article"}
HEAD_ROLES = {"header", "masthead"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
    "wbr", "br",
}
#: What an opening tag closes, up to the elements that stop it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_piece = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-zA-Z][^<]*$", re.S
)
_attribute = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_name = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: A class that says what else the page has, not what the element is.
_about = re.compile(r"(?:has|with|no|without|is)[-_]", re.I)
_host = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", re.I)


class Block:
    """A run of text in one block element; ``main`` leaves out what has no importance anywhere.

    ``title``: a heading of an article, which the tree does not judge.
    """

    __slots__ = ("article", "main", "path", "text", "title")

    def __init__(self, path: str, text: str, main: str, article: bool, title: bool):
        self.path, self.text, self.main, self.article, self.title = path, text, main, article, title


#: How an element came by a role: not at all, by words of its attributes or as a form, by words of TALK, by its tag.
_NONE, _WORDS, _TALK, _TAG = range(4)


class _Element:
    """``above``: the element around it. ``size``: characters of its text, with that of the elements in it."""

    __slots__ = ("above", "article", "children", "hidden", "own", "path", "role", "size", "tag")

    def __init__(self, above: _Element | None, tag: str, path: str, hidden: bool, own: int, article: bool):
        self.above, self.tag, self.path, self.hidden, self.own, self.article = above, tag, path, hidden, own, article
        self.children: list[str] = []
        self.size, self.role = 0, False


def _settle(elements: list[_Element]) -> None:
    """Whether each element has a role, of its own or from above; the first element is the page.

    Words on a wrapper say nothing of what it wraps. They are ignored on an element that holds the page's article (one
    with half the longest one's text and more than there is outside of roles), or nine tenths of the text of the
    page or of the article it is in.
    """
    page = elements[0]
    if any(e.own in (_WORDS, _TALK) for e in elements):
        plain = page.size
        for e in elements[1:]:
            e.role = e.above.role or e.own != _NONE
            if e.role and not e.above.role:
                plain -= e.size
        articles = [e for e in elements[1:] if e.article and not e.above.article and e.own == _NONE]
        longest = max((e.size for e in articles), default=0)
        for e in articles:
            if 2 * e.size >= longest and (e.size > plain or not e.role):
                while (e := e.above) is not page:
                    if e.own in (_WORDS, _TALK):
                        e.own = _NONE
        for e in elements[1:]:
            if e.own == _WORDS:
                whole = e.above
                while whole.above is not None and not (whole.article and not whole.above.article):
                    whole = whole.above
                if 10 * e.size >= 9 * whole.size:
                    e.own = _NONE
    for e in elements[1:]:
        e.role = e.above.role or e.own != _NONE


def read(page: str) -> tuple[list[Block], list[tuple[str, str]]]:
    """Blocks of a page's text in order, and of each element its path and its children's names."""
    root = _Element(None, "", "", False, _NONE, False)
    stack, elements, held, styles, run = [root], [root], [], [], []

    def flush() -> None:
        if run:
            holder = next(e for e in reversed(stack) if e.tag not in INLINE)
            held.append((holder, run.copy()))
            run.clear()

    def close(n: int) -> None:
        while len(stack) > n:
            if stack[-1].tag not in INLINE:
                flush()
            e = stack.pop()
            e.above.size += e.size
            styles.append((e.path, " ".join(e.children)))

    def say(text: str) -> None:
        if text and not stack[-1].hidden:
            said = entities.unescape(text)
            run.append((said, stack[-1]))
            stack[-1].size += len(said) if not said.isspace() else 0

    def open_(tag: str, attributes: str) -> None:
        if tag not in INLINE:
            flush()
            low = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in ("p", "table", "td", "button", "li")), 0)
            if stack[low].tag == "p":
                close(low)
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in stops:
                    break
                if stack[i].tag in ends:
                    close(i)
                    break
        above, names = stack[-1], []
        # inline elements in the text of an article or paragraph are words of it
        within = tag in INLINE and (above.article or any(e.tag == "p" for e in stack))
        own = _NONE
        if tag == "form":
            own = _WORDS
        elif tag in ROLE_TAGS and not within or tag == "header" and not above.article:
            own = _TAG
        for m in _attribute.finditer(attributes):
            value = m[2] or m[3] or m[4] or ""
            if m[1].lower() != "id":
                names += value.split()
            said = {w.lower() for token in value.split() if not _about.match(token) for w in _name.findall(token)}
            if above.article or tag in HEADINGS:
                said -= HEAD_ROLES  # the head of an article is part of it
            if not within and not ROLES.isdisjoint(said):
                own = max(own, _WORDS if TALK.isdisjoint(said) else _TALK)
        name = ".".join([tag, *sorted(names)])
        above.children.append(name)
        # elements that hold the whole page are what they are, whatever their classes say
        own = _NONE if tag in ("html", "body", "main") else own
        article = above.article or tag in ("article", "main") or "main" in names and 'role' in attributes
        stack.append(_Element(above, tag, f"{above.path}>{name}", above.hidden or tag in HIDDEN, own, article))
        elements.append(stack[-1])

    at = 0
    while at < len(page):
        m = _piece.search(page, at)
        if m is None:
            break
        say(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
            else:
                if tag not in INLINE:
                    flush()
            continue
        if tag == "br":
            run.append((" ", root))
            continue
        if tag in VOID:
            if tag not in INLINE:
                flush()
            stack[-1].children.append(tag)
            continue
        open_(tag, m[3])
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            stop = end.start() if end else len(page)
            say(page[at:stop])
            at = stop
    say(page[at:])
    close(1)
    flush()
    _settle(elements)
    blocks = []
    for holder, pieces in held:
        text = " ".join("".join(t for t, _ in pieces).split())
        if text:
            main = " ".join("".join(t for t, e in pieces if not e.role).split())
            title = holder.article and holder.tag in HEADINGS and holder.tag != "article"
            blocks.append(Block(holder.path, text, main, holder.article, title))
    return blocks, styles


def host_of(url: str | None) -> str:
    found = _host.match(url or "")
    return found[1].lower() if found else ""


def plain_text(page: str) -> str:
    """All text of a page, block by block."""
    return "\n".join(b.text for b in read(page)[0])


def _own(blocks: list[Block]) -> list[Block]:
    """The blocks by which a page is told from its copies: of one with an article, those in it."""
    blocks = [b for b in blocks if b.main]
    return [b for b in blocks if b.article] or blocks


def main_text(page: str, low: frozenset[str] = frozenset()) -> str:
    """Text of the page without branches of low importance; what makes up most of an article is never one."""
    blocks = [b for b in read(page)[0] if b.main]
    size, left = (sum(len(b.main) for b in blocks if b.article and (whole or b.path not in low)) for whole in (True, False))
    return "\n".join(b.main for b in blocks if b.path not in low or b.article and 2 * left < size)


def _key(*parts: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest("\0".join(parts)) - (1 << 63)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's host, the signatures of its article or text and of the whole, and its paths with their contents (kind 0) and presentations (kind 1)."""
    kind = pa.list_(pa.struct([("path", pa.string()), ("kind", pa.int32()), ("value", pa.int64())]))
    for batch in batches:
        hosts, signs, wholes, nodes = [], [], [], []
        for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            blocks, styles = read(page or "")
            hosts.append(host_of(url))
            signs.append(_key(*(b.main for b in _own(blocks))))
            judged = [b for b in blocks if b.main and not b.title]
            found = {(b.path, 0, _key(b.main)) for b in judged}
            if judged:
                judged_paths = {b.path for b in judged}
                found |= {(p, 1, _key(s)) for p, s in styles if p in judged_paths}
            nodes.append([{"path": p, "kind": k, "value": v} for p, k, v in sorted(found)])
            wholes.append(_key(*(f"{p} {k} {v}" for p, k, v in sorted(found))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts), pa.array(signs, pa.int64()), pa.array(wholes, pa.int64()), pa.array(nodes, kind)],
            ["host", "sign", "whole", "nodes"],
        )


def unimportant(pages: DataFrame) -> DataFrame:
    """``host, path, content, presentation``: the paths of low importance of every host's style tree.

    Pages with the same article (or text, without one) count once, so copies do not make their text look like a template.
    """
    found = pages.select(pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html"))
    found = found.mapInArrow(_nodes, "host string, sign long, whole long, nodes array<struct<path: string, kind: int, value: long>>")
    found = found.groupBy("host", "sign").agg(F.min_by("nodes", "whole").alias("nodes"))
    nodes = found.select("host", F.explode("nodes").alias("x")).select("host", "x.path", "x.kind", "x.value")
    counts = nodes.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("n"))
    sums = counts.groupBy("host", "path", "kind").agg(
        F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("h"), F.max("n").alias("most")
    )
    entropy = F.when(F.col("m") > 1, (F.log("m") - F.col("h") / F.col("m")) / F.log("m")).otherwise(1.0)
    each = sums.select("host", "path", "kind", "m", entropy.alias("e"))
    both = each.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind") == 0, F.col("e"))).alias("content"),
        F.max(F.when(F.col("kind") == 1, F.col("e"))).alias("presentation"),
        F.max(F.when(F.col("kind") == 0, F.col("m"))).alias("m"),
    )
    low = (F.col("content") < LEAST) & (F.coalesce("presentation", F.lit(0.0)) < LEAST) & (F.col("m") >= LEAST_PAGES)
    return both.where(low).select("host", "path", "content", "presentation")


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for page, low in zip(batch.column("html").to_pylist(), batch.column("low").to_pylist(), strict=True):
            out.append(main_text(page, frozenset(low or ())))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"]
        )


def _with_host(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts = pa.array([host_of(u) for u in batch.column("url").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, hosts], [*batch.schema.names, "host"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of every page: the blocks of its main text, joined by line breaks.

    White space in a block is one space, character references are decoded. Null html is empty and gives an empty
    text. Pages of a null or unreadable url share one nameless host. Every row of a repeated or null
    ``page_id`` has a row. No pages: no rows. Other columns are ignored.
    """
    prepare(pages.sparkSession)
    low = unimportant(pages).groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("low"))
    low = written(low.withColumnRenamed("host", "_site"), "low")
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"),
    ).mapInArrow(_with_host, "page_id long, url string, html string, host string")
    rows = rows.join(low, rows["host"] == low["_site"], "left").select("page_id", "url", "html", "low")
    return rows.mapInArrow(_extracted, "page_id long, url string, text string")
