"""Main text of web pages: wrapper induction over the pages of a host by simple tree matching."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.llm.common import slices, stage
from gridops.llm.urls import host_of
from gridops.session import bounded_broadcast

#: Elements by what they are to a reader.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup legend li main menu nav ol p pre search section summary table tbody tfoot thead tr caption ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template".split())
UNREAD = frozenset("button select datalist svg math".split())
HARD, SOFT = frozenset("nav aside footer menu dialog search".split()), frozenset("form header fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of class and id that name what is not the article; the second set only outside of one.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices banner popup"
    " modal overlay newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer"
    " comment comments commentlist replies respond disqus share sharing social related recommended widget toolbar login search".split()
)
OUTER_NAMES = frozenset("header masthead topbar".split())
#: Elements nested deeper stand in the tree beside the one at this depth; their texts stay.
DEPTH = 64
#: Skeletons of a host that its wrapper is merged from: the most frequent of so many groups of them.
SKELETONS = 4
#: A text is template if so many pages of the host, and this share of them, have it in one slot.
LEAST_PAGES, SHARE = 4, 0.6

_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>|<[!?/][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORD = re.compile("[a-z]+")


class Node:
    """An element of the block structure; ``members`` are the numbers of the page's elements that it stands for."""

    __slots__ = ("children", "key", "label", "members", "size")

    def __init__(self, label: str, children: list[Node] | None = None, members: list[int] | None = None):
        self.label, self.children, self.members = label, children or [], members or []
        self.measure()

    def measure(self) -> None:
        """Elements of the tree, and a key that equal trees share."""
        self.size = 1 + sum(c.size for c in self.children)
        self.key = hash((self.label, *(c.key for c in self.children)))


def match_weight(a: Node, b: Node) -> int:
    """Simple tree matching: most pairs of elements of both trees with equal labels, in order and below matched parents."""
    if a.label != b.label:
        return 0
    return 1 + sum(w for _, _, w in match_children(a.children, b.children))


def match_children(a: list[Node], b: list[Node]) -> list[tuple[int, int, int]]:
    """The pairs ``(index in a, index in b, weight)`` of the best alignment of two sibling lists."""
    # Equal trees at both ends are matched as they are: no other alignment is better.
    head, shorter = 0, min(len(a), len(b))
    while head < shorter and a[head].key == b[head].key:
        head += 1
    tail = 0
    while tail < shorter - head and a[-1 - tail].key == b[-1 - tail].key:
        tail += 1
    pairs = [(i, i, a[i].size) for i in range(head)]
    inner_a, inner_b = a[head : len(a) - tail], b[head : len(b) - tail]
    if inner_a and inner_b:
        weights = [[match_weight(x, y) if x.label == y.label else 0 for y in inner_b] for x in inner_a]
        best = [[0] * (len(inner_b) + 1) for _ in range(len(inner_a) + 1)]
        for i, row in enumerate(weights, 1):
            for j, w in enumerate(row, 1):
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + w)
        found, i, j = [], len(inner_a), len(inner_b)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((head + i, head + j, weights[i][j]))
        pairs += found[::-1]
    return pairs + [(len(a) - k, len(b) - k, a[-k].size) for k in range(tail, 0, -1)]


def merged(a: Node, b: Node) -> Node:
    """One tree with the elements of both, matched ones once (their labels are equal)."""
    children, i, j = [], 0, 0
    for x, y, _ in [*match_children(a.children, b.children), (len(a.children), len(b.children), 0)]:
        children += a.children[i:x] + b.children[j:y]
        if x < len(a.children) and y < len(b.children):
            children.append(merged(a.children[x], b.children[y]))
        i, j = x + 1, y + 1
    a.members.extend(b.members)
    return Node(a.label, children, a.members)


def collapsed(node: Node) -> Node:
    """The tree with neighbouring siblings of one label merged: items of a list, paragraphs, rows."""
    children: list[Node] = []
    for child in map(collapsed, node.children):
        if children and children[-1].label == child.label:
            children[-1] = merged(children[-1], child)
        else:
            children.append(child)
    return Node(node.label, children, node.members)


def skeleton(node: Node) -> str:
    """Labels of a tree in one line, children in brackets."""
    return node.label + (f"[{' '.join(map(skeleton, node.children))}]" if node.children else "")


@lru_cache(maxsize=4096)
def tree_of(line: str) -> Node:
    """The tree of a skeleton."""
    top = Node("")
    path, last = [top], top
    for label in re.findall(r"[^\s\[\]]+|[\[\]]", line):
        if label == "[":
            path.append(last)
        elif label == "]":
            path.pop()
        else:
            last = Node(label)
            path[-1].children.append(last)
    return _measured(top).children[0] if top.children else Node("html")


def _measured(node: Node) -> Node:
    for child in node.children:
        _measured(child)
    node.measure()
    return node


def preorder(node: Node) -> Iterator[Node]:
    yield node
    for child in node.children:
        yield from preorder(child)


@lru_cache(maxsize=16_384)
def slots_of(line: str, wrapper: str) -> tuple[str, ...]:
    """By preorder of the skeleton ``line``: the slot of the wrapper that each element is aligned with, else the path of its labels."""
    numbers = {id(n): i for i, n in enumerate(preorder(tree_of(wrapper)))}
    out: list[str] = []

    def walk(node: Node, other: Node | None, path: str) -> None:
        path = f"{path}/{node.label}"
        out.append(path if other is None else str(numbers[id(other)]))
        partner = {i: other.children[j] for i, j, _ in match_children(node.children, other.children)} if other else {}
        for i, child in enumerate(node.children):
            walk(child, partner.get(i), path)

    own, top = tree_of(line), tree_of(wrapper)
    walk(own, top if own.label == top.label else None, "")
    return tuple(out)


def merged_wrapper(lines: list[str]) -> str:
    """Skeleton of the tree that all ``lines`` are merged into, the first ones first."""
    tree = tree_of(lines[0])
    for line in lines[1:]:
        other = tree_of(line)
        tree = merged(tree, other) if tree.label == other.label else tree
    return skeleton(tree)


def parse_page(html: str) -> tuple[str, list[tuple[int, int, str]]]:
    """Skeleton of a page, and its blocks of text: element (by preorder of the skeleton), standing, text.

    The standing is 2 in the article, 1 outside if the page has none, 0 in menus, headers,
    footers, sidebars, notices, adverts, forms and comments. Tags may be left open, wrongly nested or cut off.
    """
    tags, parents, levels, labels, held = ["html"], [-1], [0], ["html"], [0]
    open_ = [0]  # numbers of the open elements
    blocks: list[tuple[int, str, bool]] = []
    buffer: list[str] = []
    linked = total = 0
    in_link = unread = 0

    def flush() -> None:
        nonlocal linked, total
        if buffer:
            if text := " ".join("".join(buffer).split()):
                tag = tags[open_[-1]]
                # Nothing but links outside of paragraphs and headings is a menu.
                blocks.append((open_[-1], text, linked * 5 >= total * 4 and tag not in "p h1 h2 h3 h4 h5 h6 blockquote pre".split()))
            buffer.clear()
        linked = total = 0

    def add(raw: str) -> None:
        nonlocal linked, total
        if raw and not unread:
            text = unescape(raw) if "&" in raw else raw
            buffer.append(text)
            n = len(text) - text.count(" ")
            total += n
            linked += n * (in_link > 0)

    at, skip_to = 0, 0
    for m in _TOKEN.finditer(html):
        if m.start() < skip_to:
            continue
        add(html[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if name in RAW:
            if not m[1]:
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = skip_to = end.end() if end else len(html)
            continue
        if name in UNREAD:
            unread = max(0, unread - 1) if m[1] else unread + (not m[3].rstrip().endswith("/"))
            continue
        if name == "br" or name in ("td", "th"):
            add(" ")
            continue
        if name == "a":
            in_link = 0 if m[1] else 1
            continue
        if name == "hr":
            flush()
            continue
        if name in VOID or name not in BLOCKS:
            continue
        if name == "body":
            flush()
            continue
        flush()
        unread = 0
        if m[1]:
            in_link = 0
            for depth in range(len(open_) - 1, 0, -1):
                if tags[open_[depth]] == name:
                    del open_[depth:]
                    break
                if name == "p":  # closes a paragraph, not what it stands in
                    break
            continue
        # What a start tag closes: an open paragraph, and its like among list items, terms and rows.
        if tags[open_[-1]] == "p":
            open_.pop()
        like, within = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"})}.get(name, ((), ()))
        for depth in range(len(open_) - 1, 0, -1) if like else ():
            tag = tags[open_[depth]]
            if tag in like:
                del open_[depth:]
                break
            if tag in within:
                break
        up = open_[-1]
        in_article = held[up]
        words, role = "", ""
        if "=" in m[3]:
            for key, *values in _ATTRIBUTE.findall(m[3]):
                value = "".join(values).lower()
                if key.lower() == "role":
                    role = value.strip()
                else:
                    words += " " + value
        names = set(_WORD.findall(words)) if words else set()
        if name in HARD or role in ROLES:
            level = 2
        elif name == "main" or role == "main":
            level = 0
        elif names & NAMES or name in SOFT and not (name == "header" and in_article) or (not in_article and names & OUTER_NAMES):
            level = 1
        else:
            level = 0
        number = len(tags)
        tags.append("main" if role == "main" else name)
        parents.append(up)
        levels.append(level)
        labels.append(".".join([name, *sorted(names)]))
        held.append(in_article or name == "article")
        open_.append(number)
    if at < len(html):
        rest = html[at:]
        # A tag that is cut off at the end of the page is no text.
        cut = re.search(r"<[/!a-zA-Z][^>]*\Z", rest)
        add(rest[: cut.start()] if cut else rest)
    flush()

    # The article: topmost ones outside of all that is not, else the main part, else the same inside of forms and the like.
    strict, n = levels[:], len(tags)
    for i in range(1, n):
        strict[i] = max(strict[i], strict[parents[i]])
    region: set[int] = set()
    for most in (0, 1):
        for wanted in ("article", "main"):
            region = region or {i for i in range(n) if tags[i] == wanted and strict[i] <= most}
    standing, below = [0] * n, [0] * n  # inside of a region, the level counts from it on
    for i in range(n):
        up = parents[i]
        inside = up >= 0 and standing[up] == 2
        if i in region and not inside:
            standing[i], below[i] = 2, 0
        elif inside:
            standing[i], below[i] = 2, max(below[up], levels[i])
        else:
            standing[i], below[i] = 1, max(below[up] if up >= 0 else 0, levels[i])

    nodes, depth = [Node(label, [], [i]) for i, label in enumerate(labels)], [0] * n
    for i in range(1, n):
        up = parents[i]
        if depth[up] == DEPTH:
            up = parents[i] = parents[up]
        depth[i] = depth[up] + 1
        nodes[up].children.append(nodes[i])
    tree = collapsed(nodes[0])
    place = {member: k for k, node in enumerate(preorder(tree)) for member in node.members}
    has_article = any(standing[i] == 2 and not below[i] for i, _, _ in blocks)
    out = []
    for i, text, menu in blocks:
        good = not below[i] and (standing[i] == 2 if has_article else not menu)
        out.append((place[i], (2 if has_article else 1) if good else 0, text))
    return skeleton(tree), out


def main_text(blocks: list[dict], slots: tuple[str, ...], template: set[int]) -> str:
    """Text of a page's blocks that are not template.

    A page whose article is mostly what other pages have in the same slots is a copy of them,
    not a template: it keeps its article whole; so does a page of which nothing would be left.
    """
    good = [b for b in blocks if b["standing"]]
    varying = [b for b in good if _entry(slots[b["node"]], b["text"]) not in template] if template else good
    if len(varying) < len(good):
        size = lambda some: sum(len(b["text"]) for b in some)
        if not varying or good[0]["standing"] == 2 and size(varying) * 2 < size(good):
            varying = good
    return "\n".join(b["text"] for b in varying)


_BLOCKS = pa.list_(pa.struct([("node", pa.int32()), ("standing", pa.int8()), ("text", pa.string())]))


def parsed_pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``page_id, url, host, skeleton, blocks`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            found = [parse_page(html or "") for html in batch["html"].to_pylist()]
            blocks = [[{"node": i, "standing": s, "text": t} for i, s, t in own] for _, own in found]
            yield pa.record_batch(
                [batch["page_id"], batch["url"], batch["host"], pa.array([line for line, _ in found], pa.string()), pa.array(blocks, _BLOCKS)],
                ["page_id", "url", "host", "skeleton", "blocks"],
            )

    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host_of(url).alias("host"), F.col(html_col).cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, host string, skeleton string, blocks array<struct<node:int,standing:tinyint,text:string>>")


def host_wrappers(parsed: DataFrame) -> DataFrame:
    """``host, pages, wrapper``: the merged tree of the most frequent skeletons of each host, counted over all its pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wrappers = [merged_wrapper([x["line"] for x in sorted(lines, key=lambda x: (-x["n"], x["line"]))]) for lines in batch["lines"].to_pylist()]
            yield pa.record_batch([batch["host"], batch["pages"], pa.array(wrappers, pa.string())], ["host", "pages", "wrapper"])

    counted = parsed.groupBy("host", "skeleton").agg(F.count("*").alias("n"))
    group = F.pmod(F.xxhash64("skeleton"), F.lit(SKELETONS))
    most = counted.groupBy("host", group.alias("group")).agg(F.sum("n").alias("pages"), F.max(F.struct("n", F.col("skeleton").alias("line"))).alias("most"))
    lines = most.groupBy("host").agg(F.sum("pages").alias("pages"), F.collect_list("most").alias("lines"))  # SKELETONS at most
    return lines.mapInArrow(run, "host string, pages bigint, wrapper string")


def _entry(slot: str, text: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{slot}\t{text}") - (1 << 63)


def host_templates(parsed: DataFrame, wrappers: DataFrame) -> DataFrame:
    """``host, wrapper, template``: hashes of what is constant on each host, slot and text.

    Every page is aligned with its host's wrapper; texts are counted by slot over all pages, each once
    a page. What a share of the pages has is template: at most the blocks of a page over that
    share, so a host's template stays small whatever the number of its pages. Hosts without one are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, hashes = [], []
            for host, line, wrapper, blocks in zip(*(batch[c].to_pylist() for c in ("host", "skeleton", "wrapper", "blocks")), strict=True):
                slots = slots_of(line, wrapper)
                own = {_entry(slots[b["node"]], b["text"]) for b in blocks if b["standing"]}
                hosts += [host] * len(own)
                hashes += own
            yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(hashes, pa.int64())], ["host", "hash"])

    common = wrappers.where(F.col("pages") >= LEAST_PAGES)
    entries = parsed.select("host", "skeleton", "blocks").join(bounded_broadcast(common), "host").mapInArrow(run, "host string, hash bigint")
    frequent = entries.groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_PAGES)
    constant = frequent.join(common, "host").where(F.col("n") >= F.col("pages") * SHARE)
    return constant.groupBy("host", "wrapper").agg(F.array_sort(F.collect_list("hash")).alias("template"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of every page, its blocks in page order, one a line.

    1. Pages are parsed once into a tree of block elements and their texts (white space is one
       space, character references are decoded, scripts and styles left out) and written.
    2. The skeletons of each host's pages are counted; the most frequent ones are aligned by
       simple tree matching and merged into the host's wrapper.
    3. All pages are aligned with their wrapper. A text that 0.6 of a host's pages (4 at least)
       have in one slot is template; slots that vary are content. No page is compared with another, and
       a host of any size travels as counts.
    4. The article is what varies in ``article`` (else ``main``, else the body) outside of menus, headers,
       footers, sidebars, notices, adverts, forms and comments, by element, role and the words of class and id.

    A null or empty page has empty text; a null URL is the host ''; repeated rows each get a
    row; other columns are ignored; an empty table gives no rows.
    """
    parsed = stage(parsed_pages(pages, id_col, url_col, html_col), "pages")
    templates = stage(host_templates(parsed, stage(host_wrappers(parsed), "wrappers")), "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for line, wrapper, template, blocks in zip(*(batch[c].to_pylist() for c in ("skeleton", "wrapper", "template", "blocks")), strict=True):
                texts.append(main_text(blocks, slots_of(line, wrapper) if template else (), set(template or ())))
            text = pa.array(texts, pa.string())
            yield pa.record_batch([batch["page_id"], batch["url"], text, pc.utf8_length(text).cast(pa.int64())], ["page_id", "url", "text", "n_chars"])

    joined = parsed.join(bounded_broadcast(templates), "host", "left").select("page_id", "url", "skeleton", "wrapper", "template", "blocks")
    kind = parsed.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
