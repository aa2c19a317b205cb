"""Main text of web pages by consensus paths per host.

1. Each page's containers are scored by their text outside links and boilerplate; the path of the tightest
   ones that leave no text but boilerplate (and blocks that are mostly links) outside is the page's choice.
   Nothing below an ``article`` or ``main`` is chosen.
2. Spark sums the scores per host and generalised path (tags and classes from the root, without digits);
   a host's ``RANKS`` best paths win. A choice counts with its text, so odd pages do not decide.
3. Each page is extracted again, from all containers on the first winning path that leaves no such text
   outside on this page either; a page with none of them falls back to its own choice.

Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles are known by
tag, role or class words (a class word does not count around an ``article`` or ``main``), and lists that are
mostly links are menus. Character references are decoded, white space in a block becomes one space, and
blocks are joined by line breaks in page order.

Defined cases: a null or empty page gives the empty text; pages without a host vote together; broken
markup is read as browsers do, roughly: open elements end with the page, unmatched ends are ignored; repeated
rows vote as often as they occur and get equal results; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.texts import as_bytes, slices

RANKS = 5

#: Parts that the pages of each host are dealt to, so that a host with most pages is no task's alone.
SPREAD = 64

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"

# Elements by their role in a page.
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noframes", "noembed"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_HARD = set("nav footer aside form button select menu dialog template svg canvas object head header".split())
_CONTAINERS = set("html body article main section div td center".split())
_BLOCKS = _CONTAINERS | _HARD | set(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote table thead tbody tfoot tr th caption figure figcaption "
    "address details summary fieldset hgroup".split()
)
_CLOSES_P = _BLOCKS - {"td", "th", "tr", "li"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_LISTS = {"ul", "ol", "dl", "div", "table"}
_AGAIN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
_WORDS = set(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer header masthead topbar cookie cookies consent gdpr notice alert popup "
    "modal overlay newsletter subscribe signup share sharing social related recommended recommendations comment "
    "comments commentlist replies reply disqus discussion widget login search pagination pager toolbar skip".split()
)
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "form"}


class Node(NamedTuple):
    parent: int
    tag: str
    path: str
    hard: bool
    soft: bool


class Page(NamedTuple):
    """Nodes, parents first; blocks as ``(node, text, characters within links, links)``."""

    nodes: list[Node]
    blocks: list[tuple[int, str, int, int]]


def _marks(attributes: str) -> tuple[str, bool, bool]:
    """The generalised classes, and whether attributes hide an element or name it as boilerplate."""
    classes, hidden, soft = "", False, False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "class":
            classes = "".join("." + c for c in sorted({re.sub(r"[0-9]+", "", c) for c in value.split()}) if c)
            soft |= any(w in _WORDS for w in re.split(r"[\s_0-9-]+", value))
        elif name == "id":
            soft |= any(w in _WORDS for w in re.split(r"[\s_0-9-]+", value))
        elif name == "role":
            soft |= value in _ROLES
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "")
        else:
            hidden |= name == "hidden" or value == "true"
    return classes, hidden, soft


def parse(html: str) -> Page:
    nodes = [Node(-1, "", "", False, False)]
    blocks: list[tuple[int, str, int, int]] = []
    stack = [0]
    parts: list[str] = []
    linked = links = open_links = 0
    lowered = ""
    position = 0

    def flush() -> None:
        nonlocal linked, links
        if parts:
            text = "".join(parts)
            parts.clear()
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                blocks.append((stack[-1], text, linked, links))
        linked = links = 0

    def close(upto: int) -> None:
        flush()
        del stack[upto:]

    while True:
        start = html.find("<", position)
        m = _TAG.match(html, start) if start >= 0 else None
        if start >= 0 and m is None:  # a "<" of the text
            parts.append(html[position : start + 1])
            position = start + 1
            continue
        text = html[position : start if m else len(html)]
        if text:
            parts.append(text)
            if open_links:
                linked += len(text)
        if m is None:
            break
        position = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in _RAW:
            if not m[1]:
                lowered = lowered or html.lower()
                end = lowered.find(f"</{tag}", position) if len(lowered) == len(html) else _end(html, tag, position)
                position = len(html) if end < 0 else end
            continue
        if tag == "br" or tag == "hr":
            parts.append(" ")
            continue
        if tag in _VOID:
            continue
        if tag == "a":
            open_links = 0 if m[1] else 1
            links += not m[1]
        if m[1]:
            for at in range(len(stack) - 1, 0, -1):
                if nodes[stack[at]].tag == tag:
                    close(at)
                    break
                if tag not in _BLOCKS and nodes[stack[at]].tag in _CONTAINERS:
                    break
            else:
                if tag in _BLOCKS:
                    flush()
            continue
        attributes = m[3]
        classes, hidden, soft = _marks(attributes) if "=" in attributes or "hidden" in attributes else ("", False, False)
        if tag not in _BLOCKS and not hidden and not soft:
            continue
        if tag in _BLOCKS:
            flush()
            if tag in _CLOSES_P:
                for at in range(len(stack) - 1, 0, -1):
                    if nodes[stack[at]].tag == "p":
                        close(at)
                        break
                    if nodes[stack[at]].tag in _CONTAINERS or nodes[stack[at]].tag in ("table", "ul", "ol"):
                        break
            for at in range(len(stack) - 1, 0, -1) if tag in _AGAIN else ():
                if nodes[stack[at]].tag == tag:
                    close(at)
                    break
                if nodes[stack[at]].tag in _AGAIN[tag]:
                    break
            if tag == "body" and any(nodes[i].tag == "head" for i in stack):
                close(next(k for k, i in enumerate(stack) if nodes[i].tag == "head"))
        if attributes.endswith("/") and tag not in _BLOCKS:
            continue
        path = f"{nodes[stack[-1]].path}/{tag}{classes}"
        nodes.append(Node(stack[-1], tag, path, hidden or tag in _HARD, soft))
        stack.append(len(nodes) - 1)
    close(1)
    return Page(nodes, blocks)


def _end(html: str, tag: str, position: int) -> int:
    found = re.compile(f"</{tag}", re.IGNORECASE).search(html, position)
    return found.start() if found else -1


def skipped(page: Page) -> list[bool]:
    """Whether each node is, or is in, boilerplate."""
    nodes, blocks = page
    holds = [n.tag in ("article", "main") for n in nodes]
    chars, linked, links = ([0] * len(nodes) for _ in range(3))
    for node, text, in_links, n in blocks:
        chars[node] += len(text)
        linked[node] += in_links
        links[node] += n
    for k in range(len(nodes) - 1, 0, -1):
        up = nodes[k].parent
        holds[up] |= holds[k]
        chars[up] += chars[k]
        linked[up] += linked[k]
        links[up] += links[k]
    found = [False] * len(nodes)
    within = [False] * len(nodes)  # in an article or main
    for k in range(1, len(nodes)):
        n = nodes[k]
        within[k] = within[n.parent] or n.tag in ("article", "main")
        hard = n.hard and not holds[k] and not (n.tag == "header" and within[k])
        menu = n.tag in _LISTS and links[k] >= 3 and linked[k] >= 0.8 * chars[k] and not holds[k]
        own = hard or (n.soft and not holds[k]) or menu
        if n.tag in _HEADINGS and within[k] and nodes[n.parent].tag == "header":
            own = False
        found[k] = found[n.parent] or own
    # Of a header inside an article only its headings stay.
    for k in range(1, len(nodes)):
        n = nodes[k]
        if n.tag == "header" and within[k] and not found[k]:
            found[k] = True
        elif not found[k] and found[n.parent] and n.tag not in _HEADINGS:
            found[k] = True
    return found


def solid(page: Page, skip: list[bool]) -> list[int]:
    """Characters in each node's blocks, its own and those below, that are neither skipped nor mostly links."""
    found = [0] * len(page.nodes)
    for node, text, linked, _ in page.blocks:
        if not skip[node] and 2 * linked < len(text):
            found[node] += len(text)
    for k in range(len(page.nodes) - 1, 0, -1):
        found[page.nodes[k].parent] += found[k]
    return found


def choice(page: Page, skip: list[bool]) -> tuple[str, int]:
    """``(path, score)``: the path of the tightest containers that leave nothing but boilerplate outside, not
    tighter than an article or main, and their text outside links; the empty path is the whole page."""
    nodes, blocks = page
    held = solid(page, skip)
    good = [0] * len(nodes)
    for node, text, linked, _ in blocks:
        if not skip[node]:
            good[node] += max(0, len(text) - linked)
    below: dict[int, list[int]] = {}
    covered: dict[str, int] = {}
    points: dict[str, int] = {}
    for k in range(len(nodes) - 1, -1, -1):
        if k:
            good[nodes[k].parent] += good[k]
        covered[nodes[k].path] = covered.get(nodes[k].path, 0) + held[k]
        points[nodes[k].path] = points.get(nodes[k].path, 0) + good[k]
    for k in range(1, len(nodes)):
        up = nodes[k].parent
        while up and nodes[up].tag not in _CONTAINERS:
            up = nodes[up].parent
        if nodes[k].tag in _CONTAINERS:
            below.setdefault(up, []).append(k)
    at = 0
    while True:
        best = max(below.get(at, []), key=held.__getitem__, default=0)
        if nodes[at].tag in ("article", "main") or not best or not held[best] or covered[nodes[best].path] < held[0]:
            return nodes[at].path, points[nodes[at].path]
        at = best


def extracted(page: Page, skip: list[bool], roots: set[int]) -> str:
    """The blocks below ``roots`` that are not skipped."""
    inside = [False] * len(page.nodes)
    for k, n in enumerate(page.nodes):
        inside[k] = k in roots or (k > 0 and inside[n.parent])
    return "\n".join(text for node, text, _, _ in page.blocks if inside[node] and not skip[node])


def main_text(html: str, paths: list[str]) -> str:
    """The text on the first of ``paths`` that holds all text of the page but boilerplate, else on its own choice."""
    page = parse(html)
    skip = skipped(page)
    held = solid(page, skip)

    def on(path: str) -> set[int]:
        return {k for k, n in enumerate(page.nodes) if n.path == path and not skip[k]}

    for path in paths:
        roots = on(path)
        if roots and sum(held[k] for k in roots) == held[0] and (text := extracted(page, skip, roots)):
            return text
    return extracted(page, skip, on(choice(page, skip)[0]))


def votes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(host, paths)``: the winning paths of each host, best first."""

    def score(batches):
        for batch in slices(batches, "html"):
            found: dict[tuple[str, str], int] = {}
            for host, raw in zip(batch.column("host").to_pylist(), as_bytes(batch.column("html")), strict=True):
                page = parse(raw.decode())
                path, points = choice(page, skipped(page))
                if points:
                    key = (host, path)
                    found[key] = found.get(key, 0) + points
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in found], pa.string()), pa.array([p for _, p in found], pa.string()),
                 pa.array(found.values(), pa.int64())], names=["host", "path", "points"],
            )

    counted = (
        pages.select(hosted(url), F.col(html).alias("html"))
        .mapInArrow(score, "host string, path string, points long")
        .groupBy("host", "path").agg(F.sum("points").alias("points"))
    )
    best = Window.partitionBy("host").orderBy(F.desc("points"), "path")
    return (
        counted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= RANKS)
        .groupBy("host").agg(F.array_sort(F.collect_list(F.struct("rank", "path"))).alias("ranked"))
        .select("host", F.col("ranked.path").alias("paths"))
    )


def hosted(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), _HOST, 1)), F.lit("")).alias("host")


def texts(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page, url, text, n_chars)`` of each page."""
    narrow = pages.select(F.col(page).alias("page"), F.col(url).alias("url"), hosted(url), F.col(html).alias("html"))
    salt = F.pmod(F.xxhash64("page", "url", "html"), F.lit(SPREAD)).alias("salt")
    won = votes(pages, url, html).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
    joined = narrow.select("*", salt).join(won, ["host", "salt"], "left").select("page", "url", "html", "paths")
    kind = joined.schema["page"].dataType.simpleString()

    def run(batches):
        for batch in slices(batches, "html"):
            made = [
                main_text(raw.decode(), paths or [])
                for raw, paths in zip(as_bytes(batch.column("html")), batch.column("paths").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page"), batch.column("url"), pa.array(made, pa.string()),
                 pa.array([len(x) for x in made], pa.int64())],
                names=[page, url, "text", "n_chars"],
            )

    return joined.mapInArrow(run, f"`{page}` {kind}, `{url}` string, text string, n_chars long")
