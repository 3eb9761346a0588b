"""Main-text extraction by consensus host paths.

Every page is parsed leniently.  Its containers are scored: the best one is the
deepest outside which only marked boilerplate (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, reader comments; by tag, role and class
words) and lists of links lie.  A page votes for its best container's generalised
path of tags and classes (digits as 0), weighted by its text, and names every
smaller container with the hash of its text.  In Spark, map-side first, the votes
are added up for each host and path, and a path becomes the host's boilerplate where
its text stays the same while the articles differ: on ``LEAST_PAGES`` different articles
or more, with at most one text for every two articles.

Every page is then extracted again with its host's paths: the elements of the
most voted path that the page has, in page order, without the host's boilerplate.
Where these leave out text that is in the page's own best container and is not
boilerplate, the own container is taken, without the host's boilerplate too.  So the
host's pages decide what an unmarked notice or promotion is, and no other text is lost.
Class words count for containers, and for paragraphs outside ``article`` and
``main``; never for inline elements, captions, code, lists' items or cells.

Null html gives an empty text, a null url is a host of its own, ties between
paths go to the path of the lesser hash, repeated rows are extracted one by one (and are one
article in the vote), pages of any size and depth are read whole, in time and memory that grow with their
size, an empty table gives an empty result, and other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.plans.storage import materialize

#: Voted and boilerplate paths, of 8 bytes and their hosts' names, up to which they are broadcast; beyond, pages are joined to them by host.
BROADCAST_PATHS = 200_000
#: Different articles on which a path must have been seen before its text can be the host's boilerplate.
LEAST_PAGES = 3
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title template iframe svg select object".split())
_DROP_TAGS = frozenset("nav footer aside form button dialog menu head fieldset label input".split())
_BLOCKS = frozenset(
    "address article aside blockquote body br center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCKS - {"br", "body", "html"}
#: Elements that class words can mark, and more of them outside the article.
_MARKED = frozenset("div section aside header footer ul ol dl table details iframe center".split())
_MARKED_OUTSIDE = _MARKED | frozenset("p li span a".split())
#: Elements that are blocks of their own in the vote on boilerplate.
_VOTING = frozenset("div section ul ol dl table header details center".split())
_CONTAINERS = frozenset("article body center div html main section table tbody td tr".split())
_WHOLE = frozenset(["article", "main"])
#: Elements whose text counts although it is a link's.
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dd td th".split())
_DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe signup comment comments disqus reply replies respond nav navbar navigation menu breadcrumb breadcrumbs sidebar pagination pager related recommended share sharing social toolbar widget".split()
)
_EDGE_WORDS = frozenset("header footer masthead copyright".split())
_MAIN_WORDS = frozenset("article post entry content story main body text".split())
_DROP_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")
_SCHEME = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


class Node:
    __slots__ = ("children", "drop", "head", "kind", "link", "parent", "path", "prose", "size", "tag")

    def __init__(self, tag: str, kind: str, parent: Node | None, path: int, drop: bool, link: bool, prose: bool = False) -> None:
        self.tag, self.kind, self.parent, self.path, self.drop, self.link, self.prose = tag, kind, parent, path, drop, link, prose
        self.children: list[Node | str] = []
        self.size, self.head = 0, False

    def names(self) -> str:
        """The path in words."""
        out, x = [], self
        while x is not None:
            out.append(x.kind)
            x = x.parent
        return ">".join(reversed(out))


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)} if "=" in raw or "hidden" in raw else {}


def _hash(x: str) -> int:
    return int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _node(tag: str, raw: str, parent: Node, inside: bool, known: dict[tuple[int, str], int]) -> Node:
    a = _attributes(raw)
    names = a.get("class", "").split()
    words = {w for x in (*names, a.get("id", "")) for w in re.split(r"[^a-z]+", x.lower())}
    drop = tag in _DROP_TAGS or a.get("role", "").lower() in _DROP_ROLES or "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "")
    if tag in (_MARKED if inside else _MARKED_OUTSIDE):
        drop = drop or bool(words & _DROP_WORDS)
    if tag not in ("html", "body", "article", "main") and not inside:
        drop = drop or tag == "header" or bool(words & _EDGE_WORDS) and not words & _MAIN_WORDS
    kind = ".".join([tag, *sorted(re.sub(r"\d+", "0", x) for x in names)[:3]])
    path = known.get((parent.path, kind))
    if path is None:
        path = known[parent.path, kind] = _hash(f"{parent.path}>{kind}")
    return Node(tag, kind, parent, path, parent.drop or drop, parent.link or tag == "a", parent.prose or tag in _PROSE)


def parse(page: str) -> Node:
    root = Node("", "", None, 0, False, False)
    stack, at, n, inside = [root], 0, len(page), 0
    # Numbers of open elements by tag, and the places in the stack that a new block looks at: both spare walks up a deep stack.
    known: dict[tuple[int, str], int] = {}
    count: Counter[str] = Counter()
    marks: list[int] = []

    def cut(i: int) -> None:
        nonlocal inside
        for x in stack[i:]:
            count[x.tag] -= 1
            inside -= x.tag in _WHOLE
        del stack[i:]
        while marks and marks[-1] >= i:
            marks.pop()

    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        close, tag, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if m[5] and not m[0].endswith(">"):
            break  # a tag that the page's end cuts off
        if close:
            if count[tag] > 0:
                i = len(stack) - 1
                while stack[i].tag != tag:
                    i -= 1
                cut(i)
            continue
        if tag in _CLOSES_P or tag == "p":
            i = _ended(stack, marks, tag)
            if i:
                cut(i)
        new = _node(tag, raw, stack[-1], inside > 0, known)
        stack[-1].children.append(new)
        if tag in _RAW:
            new.drop = True
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n if tag in ("script", "style") else at
        elif tag not in _VOID and not raw.rstrip().endswith("/"):
            if tag == "p" or tag in _ITEMS or tag in _STOPS:
                marks.append(len(stack))
            stack.append(new)
            count[tag] += 1
            inside += tag in _WHOLE
    return root


#: Which open items a new one ends, and the elements that such an end doesn't cross.
_ITEMS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",)}
_STOPS = _CONTAINERS | {"ul", "ol", "dl", "blockquote"}


def _ended(stack: list[Node], marks: list[int], tag: str) -> int:
    """Place of what a new block ends: an open paragraph, an item of the same list with what is open in it; 0 for none."""
    ends, at = _ITEMS.get(tag, ()), 0
    for i in reversed(marks):
        name = stack[i].tag
        if name in ends:
            return i
        if name != "p":  # an item or a container that the end doesn't cross
            break
        at = i
        if not ends:
            break
    return at


def _measure(root: Node) -> None:
    order = [root]
    for x in order:
        order.extend(c for c in x.children if isinstance(c, Node) and not c.drop)
    for x in reversed(order):
        x.head = x.tag == "h1"
        for c in x.children:
            if isinstance(c, str):
                x.size += 0 if x.link and not x.prose else len(c.strip())
            elif not c.drop:
                x.size += c.size
                x.head = x.head or c.head


def best_container(root: Node) -> Node:
    """The deepest container that still holds all text, but for lists of links, and the heading."""
    at = root
    while at.tag not in _WHOLE:
        inner = [c for c in at.children if isinstance(c, Node) and not c.drop and c.tag in _CONTAINERS]
        top = max(inner, key=lambda c: c.size, default=None)
        if top is None or not top.size or top.head < at.head:
            break
        if top.size < at.size:
            break
        at = top
    return at


def text_of(node: Node, without: frozenset[int] = frozenset()) -> str:
    """The text of an element without its parts of the paths ``without``."""
    parts: list[str] = []
    todo: list[Node | str] = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(x)
        elif not x.drop and (x is node or x.path not in without or x.tag not in _VOTING):
            block = x.tag in _BLOCKS
            todo.extend(["\n", *reversed(x.children), "\n"] if block else reversed(x.children))
    return " ".join(html.unescape("".join(parts)).split())


def host_of(url: str | None) -> str:
    m = _SCHEME.match(url or "")
    return m[1].lower() if m else ""


def page_votes(page: str) -> list[tuple[int, int, int | None, int | None]]:
    """(path, size, text, article): first the best container's path and size, then the smaller containers' paths with the hash of their texts.

    A smaller container holds no heading and at most a fifth of the best one's text; the article is known by its longest paragraph or heading.
    """
    root = parse(page)
    _measure(root)
    top = best_container(root)
    out: list[tuple[int, int, int | None, int | None]] = [(top.path, top.size, None, None)]
    longest, blocks, todo = "", [], [root]
    while todo:
        x = todo.pop()
        todo.extend(c for c in reversed(x.children) if isinstance(c, Node) and not c.drop)
        if x.tag in _PROSE and x.size > len(longest):
            own = "".join(c for c in x.children if isinstance(c, str)).strip()
            longest = max(longest, own, key=len)
        if x.tag in _VOTING and not x.head and 0 < 5 * x.size <= top.size:
            blocks.append(x)
    article = _hash(longest)
    # The outermost blocks only, so that a page's text is read once.
    taken: set[int] = set()
    for x in blocks:
        if id(x.parent) in taken:
            taken.add(id(x))
            continue
        taken.add(id(x))
        if text := text_of(x):
            out.append((x.path, x.size, _hash(text), article))
    return out


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(host_of(url), *v) for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for v in page_votes(page or "")]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], ["host", "path", "size", "text", "article"])


def extract(page: str | None, paths: list[int] | None, boilerplate: list[int] | None = None) -> tuple[str, str]:
    """(text, path used) of a page whose host voted for ``paths``, the best first, and found ``boilerplate`` paths."""
    root = parse(page or "")
    _measure(root)
    own, without = best_container(root), frozenset(boilerplate or ())
    rank = {p: i for i, p in enumerate(paths or ())}
    found: dict[int, list[Node]] = {}
    todo = [root]
    while rank and todo:
        x = todo.pop()
        if x.path in rank:
            found.setdefault(rank[x.path], []).append(x)
        todo.extend(c for c in reversed(x.children) if isinstance(c, Node) and not c.drop)
    chosen = found[min(found)] if found else [own]  # elements of one path are equally deep, so none lies in another
    if chosen != [own] and _prose([own], without) > _prose(chosen, without):
        chosen = [own]
    return " ".join(t for x in chosen if (t := text_of(x, without))), chosen[0].names()


def _prose(nodes: list[Node], without: frozenset[int]) -> int:
    """Characters of prose outside the boilerplate."""
    total, todo = 0, [(x, True) for x in nodes]
    while todo:
        x, first = todo.pop()
        if not first and x.path in without and x.tag in _VOTING:
            continue
        for c in x.children:
            if isinstance(c, str):
                total += 0 if x.link and not x.prose else len(c.strip())
            elif not c.drop:
                todo.append((c, False))
    return total


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [extract(page, paths, gone) for page, paths, gone in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
        columns = [batch.column(0), batch.column(1), pa.array([t for t, _ in got], pa.string()), pa.array([len(t) for t, _ in got], pa.int64()), pa.array([p for _, p in got], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars", "path"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, paths, boilerplate) from the votes of all pages (url, html).

    A path that only one page voted for is that page's own container anyway, so only shared ones are kept.
    """
    votes = pages.select("url", "html").mapInArrow(_votes, "host string, path long, size long, text long, article long")
    by_path = votes.groupBy("host", "path").agg(
        F.sum(F.when(F.col("text").isNull(), F.col("size"))).alias("weight"),
        F.count_if(F.col("text").isNull()).alias("pages"),
        F.approx_count_distinct("text", 0.02).alias("texts"),
        F.approx_count_distinct("article", 0.02).alias("articles"),
    )
    same = (F.col("articles") >= LEAST_PAGES) & (2 * F.col("texts") <= F.col("articles"))
    kept = by_path.where((F.col("pages") > 1) | same)
    ranked = F.array_sort(F.collect_list(F.when(F.col("pages") > 1, F.struct((-F.col("weight")).alias("w"), F.col("path").alias("path")))))
    return kept.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("paths"), F.collect_list(F.when(same & (F.col("pages") == 0), F.col("path"))).alias("boilerplate"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars and the path used."""
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    known = materialize(host_paths(pages), "host-paths")
    if (known.agg(F.sum(F.size("paths") + F.size("boilerplate") + 4)).first()[0] or 0) <= BROADCAST_PATHS:
        known = F.broadcast(known)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.withColumn("host", host).join(known, "host", "left").select("page_id", "url", "html", "paths", "boilerplate").mapInArrow(_extract, "page_id long, url string, text string, n_chars long, path string")
