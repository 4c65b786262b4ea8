"""Main text of web pages by a site style tree over the pages of each host."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow, saved

#: The elements of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|iframe|noembed|noframes|xmp"
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html li dd dt tbody td tfoot th thead tr option".split())
CLOSED_BY_SAME = {"li": "ul ol menu dir", "dt": "dl", "dd": "dl", "option": "select", "tr": "table", "td": "table tr", "th": "table tr"}
NOISE_TAGS = frozenset(
    "script style noscript template iframe nav header footer aside form button select textarea title head svg object embed menu dialog "
    "canvas audio video noembed noframes xmp datalist".split()
)
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb "
    "breadcrumbs header footer masthead sidebar aside widget cookie cookies consent notice notices popup modal newsletter subscribe signup "
    "comment comments respond disqus share sharing social related recommended login search skip pagination pager copyright".split()
)
#: Names that an element with the article carries, and parts of names that tell what it lacks or asks for.
CONTENT_WORDS = frozenset("content article post entry story main body text page".split())
NEGATIONS = frozenset("no not without non hide hidden required free".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Branches that the style tree may remove; running text is never one.
REMOVABLE = frozenset("div section table ul ol dl figure details center fieldset span".split())
CONTENT = frozenset(["article", "main"])

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>(?:.*?</\1\s*>|.*\Z)|<[!?][^>]*>"
    r"|<(/?)([a-z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-z][^\s/>]*)([^>]*)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemtype|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
NAME = re.compile(r"[a-z]+|[0-9]+", re.I)


class Node:
    """An open element: its place in the style tree, and digests of what it holds."""

    __slots__ = ("below", "content", "inside", "keeps", "label", "path", "shape", "tag")

    def __init__(self, tag: str, label: str, parent: Node | None, noise: bool) -> None:
        self.tag, self.label = tag, label
        self.path = crc32(label.encode(), parent.path & 0xFFFFFFFF) | crc32(label.encode(), parent.path >> 32 ^ 0x5BD1E995) << 32 if parent else 1
        self.keeps = not noise and (parent is None or parent.keeps)
        self.inside = tag in CONTENT or (parent is not None and parent.inside)
        self.below = parent
        self.shape = self.content = 0


def says_noise(names: str) -> bool:
    """Does one of the names hold a word of NOISE_WORDS, no negation, and none name the article?"""
    parts = [set(NAME.findall(name)) for name in names.split()]
    return any(p & NOISE_WORDS and not p & NEGATIONS for p in parts) and not any(p and p <= CONTENT_WORDS for p in parts)


def label_of(tag: str, attributes: str) -> tuple[str, bool]:
    """(style label, does the element's own markup say that it is no content)."""
    noise = tag in NOISE_TAGS
    if not attributes or attributes.isspace():
        return tag, noise
    label = tag
    for name, *values in ATTRIBUTE.findall(attributes):
        value, name = "".join(values).lower(), name.lower()
        if name in ("class", "id"):
            label += f".{value}" if name == "class" else f"#{value}"
            noise = noise or (tag not in ("html", "body", "article", "main") and says_noise(value))
        elif name == "role":
            noise = noise or value in NOISE_ROLES
            label += f"[{value}]"
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            noise = True
    return label, noise


def walk(page: str) -> Iterator[tuple[str, Node, str]]:
    """("text", node, decoded text), ("break", node, "") at the edges of blocks, ("close", node, "") for each element."""
    root = Node("#root", "#root", None, False)
    stack, last = [root], 0

    def close_to(depth: int) -> Iterator[tuple[str, Node, str]]:
        while len(stack) > depth:
            node = stack.pop()
            above = stack[-1]
            above.shape = crc32(node.label.encode(), above.shape)
            above.content = crc32(node.content.to_bytes(4, "little"), above.content)
            yield "close", node, ""
            if node.tag in BLOCK:
                yield "break", above, ""

    def depth_of(tag: str, fences: tuple[str, ...]) -> int:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag == tag:
                return depth
            if stack[depth].tag in fences:
                break
        return 0

    def text(part: str) -> Iterator[tuple[str, Node, str]]:
        if part:
            node, decoded = stack[-1], html.unescape(part)
            if not decoded.isspace():
                node.content = crc32(" ".join(decoded.split()).encode("utf-8", "replace"), node.content)
            yield "text", node, decoded

    for m in TOKEN.finditer(page):
        yield from text(page[last : m.start()])
        last = m.end()
        end, tag, attributes = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            if depth := depth_of(tag, ("#root",)):
                yield from close_to(depth)
            elif tag in BLOCK:
                yield "break", stack[-1], ""
            continue
        if tag in CLOSES_P and (depth := depth_of("p", ("td", "th", "button", "object", "caption"))):
            yield from close_to(depth)
        if tag in CLOSED_BY_SAME and (depth := depth_of(tag, tuple(CLOSED_BY_SAME[tag].split()))):
            yield from close_to(depth)
        if tag in BLOCK:
            yield "break", stack[-1], ""
        elif tag == "br":
            yield "text", stack[-1], " "
        if tag not in VOID and not attributes.endswith("/"):
            label, noise = label_of(tag, attributes)
            if tag == "header" and label == tag and any(node.tag == "article" for node in stack):
                noise = False  # The article's own, with its title.
            stack.append(Node(tag, label, stack[-1], noise))
    yield from text(page[last:])
    yield from close_to(1)


def style_nodes(page: str) -> dict[int, list[int]]:
    """path -> [digest of child labels, digest of content] of a page's removable branches, and of its content element.

    Nodes of one page with one path count as one node of the tree.
    """
    found: dict[int, list[int]] = {}
    for event, node, _ in walk(page):
        if event == "close" and (node.tag in REMOVABLE or node.tag in CONTENT):
            both = found.setdefault(node.path, [0, 0])
            both[0] = crc32(node.shape.to_bytes(4, "little"), both[0])
            both[1] = crc32(node.content.to_bytes(4, "little"), both[1])
    return found


def main_text(page: str, low: frozenset[int]) -> str:
    """Blocks of the article, or of the whole page if it has none, without noise and branches of low importance."""
    blocks: list[tuple[bool, str]] = []
    parts: list[str] = []
    inside = False

    def kept(node: Node) -> bool:
        if not node.keeps:
            return False
        while low and node is not None:
            if node.path in low and node.tag in REMOVABLE:
                return False
            node = node.below
        return True

    def flush() -> None:
        words = "".join(parts).split()
        if words:
            blocks.append((inside, " ".join(words)))
        parts.clear()

    was: tuple[Node | None, bool] = (None, False)
    for event, node, decoded in walk(page):
        if event == "break":
            flush()
        elif event == "text":
            if was[0] is not node:
                was = (node, kept(node))
            if was[1]:
                if parts and inside != node.inside:
                    flush()
                inside = node.inside
                parts.append(decoded)
    flush()
    if any(content for content, _ in blocks):
        blocks = [b for b in blocks if b[0]]
    return "\n".join(text for _, text in blocks)


def host_of(url_col: str):
    """Host of an address in lower case; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The merged trees of all hosts: (host, path, pages, importance), one row per style node.

    Importance is the larger of two entropies over the host's pages, each over its largest possible value:
    that of what nodes of this style hold (content) and that of their children's styles (presentation). A
    style that one page has alone has importance 1.
    """

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            hosts, paths, shapes, contents = [], [], [], []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for path, (shape, content) in style_nodes(page or "").items():
                    hosts.append(host)
                    paths.append(path - (1 << 63))
                    shapes.append(shape)
                    contents.append(content)
            return pa.record_batch([pa.array(hosts, pa.string()), pa.array(paths, pa.int64()), pa.array(shapes, pa.int64()), pa.array(contents, pa.int64())], names=["host", "path", "shape", "content"])

        return step

    nodes = map_arrow(pages.select(host_of(url_col).alias("host"), F.col(html_col)), make, "host string, path long, shape long, content long")
    feature = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("shape").alias("v")), F.struct(F.lit(1).alias("kind"), F.col("content").alias("v"))))
    counts = nodes.select("host", "path", feature.alias("f")).groupBy("host", "path", "f.kind", "f.v").count()
    n = F.sum("count")
    entropy = (F.log(n) - F.sum(F.col("count") * F.log("count")) / n) / F.log(n)
    kinds = counts.groupBy("host", "path", "kind").agg(n.alias("pages"), F.when(n > 1, entropy).otherwise(1.0).alias("importance"))
    return kinds.groupBy("host", "path").agg(F.max("pages").alias("pages"), F.max("importance").alias("importance"))


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: float = 0.2, least_pages: int = 8, most_broadcast: int = 50_000
) -> DataFrame:
    """(id_col, url_col, text, n_chars) of each page.

    Branches that at least least_pages pages of a host share and whose importance is below threshold go, and with
    them what its own markup shows to be menu, header, footer, sidebar, notice, advert, form, script or reader
    comments. The low branches of all hosts are broadcast if they are at most most_broadcast rows; otherwise
    pages join them by host, which Spark splits where a host is hot.

    Null and empty html give an empty text; a null url is a host of its own. Repeated rows give repeated results.
    Other columns of pages are not read.
    """
    low = style_tree(pages, url_col, html_col).filter((F.col("pages") >= least_pages) & (F.col("importance") < threshold))
    low = low.groupBy("host").agg(F.collect_list("path").alias("low"))
    own = pages.select(F.col(id_col), F.col(url_col), host_of(url_col).alias("host"), F.col(html_col).alias("html"))
    low = saved(low)
    rows = low.agg(F.sum(F.size("low")), F.sum(F.length("host"))).first()
    if (rows[0] or 0) <= most_broadcast and (rows[1] or 0) <= 64 * most_broadcast:
        low = F.broadcast(low)
    joined = own.join(low, "host", "left").select(id_col, url_col, "html", "low")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = []
            for page, paths in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                texts.append(main_text(page or "", frozenset(p + (1 << 63) for p in paths or ())))
            return pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

        return step

    id_kind, url_kind = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    return map_arrow(joined, make, f"`{id_col}` {id_kind}, `{url_col}` {url_kind}, text string, n_chars long")
