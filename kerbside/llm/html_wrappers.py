"""Main text of web pages through wrappers: union-free regular expressions inferred per host.

A page is a token stream of tags and texts. Pages of one host are aligned one after another:
where they agree the wrapper keeps the token; texts that differ become slots; elements that one
side lacks become optional groups; neighbours of one kind become a repeated group. Each task folds
the pages it reads into one wrapper per host, and those few wrappers are aligned with each other,
so a host with a third of all pages is never one task's work. A wrapper names the regions that
hold the main text and the texts that are constant on the host; of a page, the slots, optional and
repeated parts of these regions are read, and constant texts are not.

Defined cases: a missing or empty page has the empty text; pages whose url names no host are
one host ''; a page without its host's regions is read as a whole, less what is never main text;
broken markup closes at its parent's end;
elements nested deeper than DEEPEST are read as part of
the element at that depth, each between its own borders; repeated rows are extracted one by one; columns other
than `page_id`, `url` and `html` are ignored.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import slices, stored, texts

# FIXED VALUES: elements by their part in a page.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
}
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "title", "svg", "select"}
NEVER = RAW | {
    "head", "nav", "footer", "aside", "form", "button", "dialog", "menu", "object", "canvas",
    "audio", "video",
}
MAIN = {"article", "main"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "dd", "details", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hgroup", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section",
    "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
}
SPACED = {"br", "td", "th"}
# A tag of the left kind ends an open element of the right kinds, up to the nearest container.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
CONTAINERS = {
    "ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "article", "section", "div", "main",
    "body", "html", "td",
}
# Words of class, id and role that mark what is not main text.
ASIDE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored",
    "promo", "promotion", "banner", "sidebar", "sidenav", "menu", "nav", "navbar",
    "navigation", "breadcrumb", "breadcrumbs", "toolbar", "masthead", "footer", "cookie",
    "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay",
    "newsletter", "subscribe", "signup", "social", "share", "sharing", "related",
    "recommended", "comment", "comments", "disqus", "replies", "reply", "respond", "search",
    "login", "pagination", "pager", "widget", "widgets", "complementary", "contentinfo",
    "alertdialog",
}
# Words that say nothing about the part: a name of these and at least one of ASIDE marks an aside.
NEUTRAL = {
    "area", "bar", "block", "body", "bottom", "box", "container", "content", "form", "global",
    "group", "inner", "item", "items", "left", "link", "links", "list", "main", "outer", "page",
    "panel", "primary", "right", "section", "site", "slot", "top", "unit", "wrap", "wrapper",
}
# Never an aside by name, nor is what holds one of them.
HOLDS = {"html", "body", "article", "main"}

# Elements nested deeper count as their parent's texts.
DEEPEST = 200

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Node:
    """An element, or a text (`label` is '#'). As a wrapper part it may be a group."""

    label: str
    aside: bool = False  # by its tag or as hidden
    named: bool = False  # an aside by its names, if the host's wrapper confirms it
    holds: bool = False  # holds an element of HOLDS
    text: str | None = None  # of texts; None is a slot
    children: list[Node] = field(default_factory=list)
    optional: bool = False
    repeated: bool = False
    size: int = 0  # characters of text


@dataclass(slots=True)
class Under:
    """Where an open element's texts go, and what is above them."""

    node: Node
    depth: int = 0
    aside: bool = False
    main: bool = False


def _attributes(raw: str) -> tuple[str, bool, bool]:
    """The naming attributes as a label, whether the element is hidden, and named as an aside."""
    label, hidden, named = "", False, False
    if raw and not raw.isspace():
        seen = set()
        for name, value in _ATTRIBUTE.findall(raw):
            name, value = name.lower(), value.strip("\"'")
            if name in seen:  # the first of a name counts
                continue
            seen.add(name)
            if name == "hidden" or name == "aria-hidden":
                hidden |= name == "hidden" or value.lower() == "true"
            elif name in ("class", "id", "role"):
                if name != "id":
                    label += f".{value}"
                named |= any(map(_marks, value.split()))
    return label, hidden, named


def _marks(name: str) -> bool:
    """Whether a class, id or role names an aside: by all of its words, neutral ones aside."""
    parts = {p.lower() for p in _PART.findall(name)}
    return bool(parts & ASIDE) and parts <= ASIDE | NEUTRAL


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """('open', tag, attributes), ('close', tag, '') and ('text', '', text) of a page."""
    at = 0
    while at < len(page):
        found = _TOKEN.match(page, at)
        at = found.end()
        if page[found.start()] != "<" or found.group() == "<":
            yield "text", "", found.group()
            continue
        tag = found.group(2) or found.group(5)
        if tag is None:  # comment or declaration
            continue
        tag, raw = tag.lower(), found.group(3) or found.group(6) or ""
        if found.group(1) or found.group(4):
            yield "close", tag, ""
            continue
        yield "open", tag, raw
        if tag in VOID or raw.endswith("/"):
            yield "close", tag, ""
        elif tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            yield "close", tag, ""


def parse(page: str) -> Node:
    """The page's elements as a tree; unclosed ones end with their parent.

    An element below DEEPEST stays on the path, so that its end tag closes it and no other; its
    texts go to its nearest ancestor in the tree, between borders that stand for its own.
    """
    # The root's text is the page's digest: None in a wrapper of pages that differ.
    root = Node("", text=hashlib.sha256(page.encode(errors="replace")).hexdigest())
    path, under = [root], [Under(root)]
    opened: Counter[str] = Counter()

    def border(at: Node, tag: str) -> None:
        if tag in BLOCKS or tag in SPACED:
            label = "p" if tag in BLOCKS else "br"
            last = at.children[-1] if at.children else None
            if last is None or last.label != label or last.children:
                at.children.append(Node(label))

    def close(depth: int) -> None:
        while len(path) > depth:
            node, place = path.pop(), under.pop()
            opened[_tag(node.label)] -= 1
            if place.node is not node:
                border(place.node, _tag(node.label))

    for kind, tag, value in tokens(page):
        place = under[-1]
        if kind == "text":
            place.node.children.append(Node("#", text=html.unescape(value), size=len(value)))
            continue
        if kind == "close":
            if opened[tag]:
                close(next(d for d in range(len(path) - 1, 0, -1) if _tag(path[d].label) == tag))
            continue
        ends = {"p"} if tag in BLOCKS else set()
        ends |= ENDS.get(tag, set())
        if any(opened[e] for e in ends):
            for depth in range(len(path) - 1, 0, -1):
                name = _tag(path[depth].label)
                if name in ends:
                    close(depth)
                    break
                if name in CONTAINERS:
                    break
        label, aside, named = _attributes(value)
        place = under[-1]
        if tag in HOLDS:
            named = False
            for above in reversed(path):
                if above.holds:
                    break
                above.named, above.holds = False, True
        aside |= tag in NEVER or tag == "header" and not place.main
        node = Node(tag + label, aside, named, holds=tag in HOLDS)
        at = node
        if place.depth >= DEEPEST and (place.aside or not (aside or named)):
            at = place.node  # its texts go there
            border(at, tag)
        else:
            place.node.children.append(node)
        path.append(node)
        under.append(Under(at, place.depth + (at is node), place.aside or aside or named,
                           place.main or tag in MAIN))
        opened[tag] += 1
    close(1)
    return root


def _tag(label: str) -> str:
    return label.partition(".")[0]


def fold(node: Node) -> Node:
    """A wrapper of one page: neighbours of one kind become one repeated group."""
    out = Node(node.label, node.aside, node.named, text=node.text, size=node.size)
    for child in node.children:
        if child.label == "#" and child.text.isspace():
            continue
        part = fold(child)
        out.size += part.size
        if out.children and out.children[-1].label == part.label:
            out.children[-1] = _merge(out.children[-1], part)
            out.children[-1].repeated = True
        else:
            out.children.append(part)
    return out


def _pairs(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    """Longest common subsequence of labels."""
    if [x.label for x in a] == [y.label for y in b]:
        return [(i, i) for i in range(len(a))]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = (best[i + 1][j + 1] + 1 if a[i].label == b[j].label
                          else max(best[i + 1][j], best[i][j + 1]))
    i = j = 0
    out = []
    while i < len(a) and j < len(b):
        if a[i].label == b[j].label:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _merge(a: Node, b: Node) -> Node:
    """The wrapper of both: slots for differing texts, optional and repeated groups."""
    out = Node(a.label, a.aside and b.aside, a.named and b.named, text=a.text if a.text == b.text else None,
               optional=a.optional or b.optional, repeated=a.repeated or b.repeated,
               size=a.size + b.size)

    def add(part: Node) -> None:
        if out.children and out.children[-1].label == part.label:
            last = out.children.pop()
            optional = last.optional and part.optional
            part = _merge(last, part)
            part.repeated, part.optional = True, optional
        out.children.append(part)

    def skip(parts: list[Node]) -> None:
        for part in parts:
            part.optional = True
            add(part)

    i = j = 0
    for p, q in [*_pairs(a.children, b.children), (len(a.children), len(b.children))]:
        skip(a.children[i:p])
        skip(b.children[j:q])
        if p < len(a.children):
            add(_merge(a.children[p], b.children[q]))
        i, j = p + 1, q + 1
    return out


def _together(a: Node, b: Node) -> Node:
    """The wrapper of both pages; an empty page says nothing of its host."""
    return _merge(a, b) if a.children and b.children else a if a.children else b


def expression(node: Node) -> str:
    """The wrapper as a union-free regular expression over tokens."""
    if node.label == "#":
        body = "#" if node.text is None else json.dumps(node.text, ensure_ascii=False)
    else:
        inner = " ".join(map(expression, node.children))
        body = f"<{node.label}> {inner} </{_tag(node.label)}>" if node.label else inner
    if node.optional or node.repeated:
        body = f"( {body} ){'*' if node.optional and node.repeated else '?' if node.optional else '+'}"
    return body


def confirmed(node: Node) -> bool:
    """Whether the host's pages agree with an aside's name: it repeats, or its texts are constant."""
    if node.repeated:
        return True
    if node.label == "#":
        return node.text is not None
    return any(c.repeated for c in node.children) or all(map(confirmed, node.children))


def unconfirmed(wrapper: Node) -> list[str]:
    """Paths of elements named as asides that the wrapper does not confirm: their text stays."""
    out: list[str] = []

    def search(node: Node, path: str) -> None:
        for child in node.children:
            if child.label != "#":
                here = f"{path}/{child.label}"
                if child.named and not confirmed(child):
                    out.append(here)
                search(child, here)

    search(wrapper, "")
    return out


def regions(wrapper: Node) -> list[str]:
    """Paths of the wrapper's elements that hold the main text.

    `article` and `main` elements outside any aside; without one, the whole page.
    """
    named: list[str] = []

    def search(node: Node, path: str) -> None:
        for child in node.children:
            if child.label == "#" or child.aside or child.named and confirmed(child):
                continue
            here = f"{path}/{child.label}"
            if _tag(child.label) in MAIN:
                named.append(here)
            else:
                search(child, here)

    search(wrapper, "")
    return named or [""]


def constants(wrapper: Node) -> list[str]:
    """Paths and texts that every page of the host has: what alignment left neither as a slot nor
    in an optional group. A wrapper of one page, or of equal ones, tells nothing."""
    out: set[str] = set()
    below = [(wrapper, "")] if wrapper.text is None else []
    while below:
        node, path = below.pop()
        for child in node.children:
            if child.optional:
                continue
            if child.label != "#":
                below.append((child, f"{path}/{child.label}"))
            elif child.text is not None:
                out.add(_placed(path, child.text))
    return sorted(out)


def _placed(path: str, text: str) -> str:
    return f"{path}\0{text}"


def extract(
    page: str, main: list[str], stays: Iterable[str] = (), constant: Iterable[str] = ()
) -> str:
    """The slots, optional and repeated parts of the main regions, in blocks joined by newlines.

    `constant` are the wrapper's constant texts by path; a page that has nothing else keeps them.

    `stays` are paths of elements whose names mark an aside that the host does not confirm.
    """
    stays, constant = set(stays), set(constant)
    root = parse(page)
    blocks: list[str] = []
    open_block: list[str] = []

    def end() -> None:
        text = " ".join("".join(open_block).split())
        if text:
            blocks.append(text)
        open_block.clear()

    def skipped(node: Node, path: str) -> bool:
        return node.aside or node.named and path not in stays

    def read(node: Node, path: str) -> None:
        for child in node.children:
            if child.label == "#":
                fixed = constant and _placed(path, child.text) in constant
                open_block.append(" " if fixed else child.text)
                continue
            here = f"{path}/{child.label}"
            if not skipped(child, here):
                tag = _tag(child.label)
                if tag in BLOCKS:
                    end()
                    read(child, here)
                    end()
                elif tag in SPACED:
                    open_block.append(" ")
                    read(child, here)
                else:
                    read(child, here)

    def find(node: Node, path: str) -> bool:
        if path in wanted:
            end()
            read(node, path)
            end()
            return True
        found = False
        for child in node.children:
            here = f"{path}/{child.label}"
            if child.label != "#" and not skipped(child, here):
                found |= find(child, here)
        return found

    wanted = set(main)
    if not wanted or not find(root, ""):
        read(root, "")
        end()
    if not blocks and constant:
        return extract(page, main, stays)
    return "\n".join(blocks)


# ---- wrappers on Spark -------------------------------------------------------------


def _pack(node: Node) -> list:
    return [node.label, node.aside, node.named, node.text, node.optional, node.repeated, node.size,
            [_pack(c) for c in node.children]]


def _unpack(row: list) -> Node:
    label, aside, named, text, optional, repeated, size, children = row
    return Node(label, aside, named, False, text, [_unpack(c) for c in children], optional, repeated, size)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(found)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, regions, stays, constant): the inferred wrapper of every host."""

    def emit(known: dict[str, Node], final: bool) -> Iterator[pa.RecordBatch]:
        hosts = list(known)
        if final:
            columns = [pa.array([expression(known[h]) for h in hosts], pa.string()),
                       pa.array([regions(known[h]) for h in hosts], pa.list_(pa.string())),
                       pa.array([unconfirmed(known[h]) for h in hosts], pa.list_(pa.string())),
                       pa.array([constants(known[h]) for h in hosts], pa.list_(pa.string()))]
            names = ["host", "wrapper", "regions", "stays", "constant"]
        else:
            columns = [pa.array([json.dumps(_pack(known[h])) for h in hosts], pa.string())]
            names = ["host", "part"]
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *columns], names)

    def infer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Node] = {}
        for batch in slices(batches, "html"):
            for host, page in zip(texts(batch, "host"), texts(batch, "html"), strict=True):
                part = fold(parse(page))
                known[host] = _together(known[host], part) if host in known else part
            if len(known) > 2_000:  # bounded memory: the parts meet again by host
                yield from emit(known, False)
                known.clear()
        if known:
            yield from emit(known, False)

    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, whole = None, None
        for batch in batches:
            for name, part in zip(texts(batch, "host"), texts(batch, "part"), strict=True):
                node = _unpack(json.loads(part))
                if whole is not None and name == host:
                    whole = _together(whole, node)
                    continue
                if whole is not None:
                    yield from emit({host: whole}, True)
                host, whole = name, node
        if whole is not None:
            yield from emit({host: whole}, True)

    parts = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(
        infer, "host string, part string")
    return (
        stored(parts, "wrapper-parts").repartition("host").sortWithinPartitions("host", "part")
        .mapInArrow(align, "host string, wrapper string, regions array<string>, stays array<string>, "
                    "constant array<string>")
    )


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, text): the main text of every page by its host's wrapper."""
    named = stored(wrappers(pages), "wrappers").select(
        "host", "regions", "stays", "constant")
    # Spark broadcasts the written wrappers if their size allows it, and joins by host otherwise.
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html",
        host_of(F.col("url")).alias("host"),
    ).join(named, "host", "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            regions_ = batch.column("regions").to_pylist()
            stays = batch.column("stays").to_pylist()
            constant = batch.column("constant").to_pylist()
            found = [extract(page, main or [], kept or [], fixed or [])
                     for page, main, kept, fixed in zip(
                         texts(batch, "html"), regions_, stays, constant, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), batch.column("host"),
                 pa.array(found, pa.string())], ["page_id", "url", "host", "text"])

    return source.mapInArrow(run, "page_id long, url string, host string, text string")
