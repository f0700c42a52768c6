"""Main text of web pages by wrapper induction.

Each page is parsed into a DOM tree in which siblings with the same label (tag, classes) are one node. The commonest tree of
a host is its wrapper; the trees of the host's other pages are aligned with it by simple tree matching (the largest mapping
that keeps order and ancestry), which gives each text block a slot of the wrapper. A text that most of the host's different
pages have in a slot is template and goes; pages with the same blocks count once, so that copies of one article don't make
it a template. What varies is weighed: each slot of the wrapper gets the length of its different texts, and the content is
what stands below the explicit articles (article, main) if they hold half of the weight, else below the innermost
element that holds nearly all of it. Elements made for something else by tag or role (menus, footers, asides, forms,
scripts) have no weight; an element whose class or id says so (adverts, comments, banners) has none unless it
holds an article, or, if it has elements itself, most of the weight. A page whose blocks the wrapper doesn't know, or whose host has too few
different pages to tell what varies, is weighed on its own tree.

Hosts are never gathered: wrappers, constant texts and weights come from aggregates by (host, tree), (host, slot, text) and
(host, slot). Null or empty html gives an empty text; a url without a host counts as a host of its own kind; rows that repeat
give rows that repeat. Broken markup is read as browsers do: open elements end where their kind can't go on, and a tag that
the page's end cuts off is dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

#: Possessive throughout, so that a tag without an end costs one pass.
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|</?[a-zA-Z](?>[^>"'=]++|=\s*+(?>"[^"]*+"|'[^']*+')?+|["'])*+>""", re.S)
_CUT_OFF = re.compile(r"</?[a-zA-Z]")
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-label|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg xmp noembed".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ASIDE = frozenset("head nav footer aside form button select menu dialog input object audio video canvas label option datalist".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
#: Words of class or id that mark what isn't the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription comment comments commentlist disqus respond sidebar side aside menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar share sharing social related recommended widget login signup search pagination pager toolbar skip legal copyright disclaimer".split()
)
#: An element of this kind ends the open ones named, up to the barrier.
_ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
_SCOPE = frozenset(["table", "td", "th", "button", "object", "html", "body"])
#: Put before the label of an element whose class or id has one of MARKS.
MARKED = "!"
#: Shares of the weight: of the articles for them to be the content, of an element for its marks to say nothing or for it to
#: be looked into, of an article beside the largest.
ARTICLES, MOST, BESIDE = 0.5, 0.75, 1 / 3


def _marks(tag: str, token: str) -> tuple[bool, str]:
    """Whether the element is made for something else by tag or role; its label in the tree."""
    off, label, marked = tag in ASIDE, tag, False
    if " " in token or "\n" in token:
        for m in _ATTRIBUTE.finditer(token, len(tag) + 1):
            name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
            if name == "hidden":
                off = off or "=" in m[0] or not m[2]
            elif name == "role":
                off = off or value in ROLES
            elif name in ("class", "id"):
                words = _SPLIT.split(value)
                marked = marked or tag not in ("html", "body", "article", "main") and not MARKS.isdisjoint(words)
                if name == "class":
                    label += "." + "-".join(words)
    return off, MARKED * marked + label


class Page:
    """Blocks [(node, text)] of the parts that aren't made for something else, and the tree [(label, parent)]."""

    def __init__(self, html: str) -> None:
        self.tree: list[tuple[str, int]] = []
        self.blocks: list[tuple[int, str]] = []
        children: dict[tuple[int, str], int] = {}
        stack: list[tuple[str, int, bool, bool]] = []  # tag, node, made for something else, in an article
        text: list[str] = []
        where: int | None = None

        def flush() -> None:
            nonlocal where
            if text and where is not None:
                joined = " ".join(" ".join(text).split()) if len(text) == 1 else " ".join("".join(text).split())
                if joined:
                    self.blocks.append((where, joined))
            text.clear()
            where = None

        def node_of(label: str) -> int:
            parent = stack[-1][1] if stack else -1
            node = children.setdefault((parent, label), len(self.tree))
            if node == len(self.tree):
                self.tree.append((label, parent))
            return node

        def data(raw: str) -> None:
            nonlocal where
            if stack and stack[-1][2]:
                return
            if where is None:
                if not raw.strip():
                    return
                where = stack[-1][1] if stack else -1
            text.append(unescape(raw) if "&" in raw else raw)

        def close(down_to: int) -> None:
            if any(x[0] in BLOCKS for x in stack[down_to:]):
                flush()
            del stack[down_to:]

        at, n = 0, len(html)
        last = html.rfind(">")
        while at < n:
            m = _TOKEN.search(html, at) if at <= last else None
            if m is None:
                cut = _CUT_OFF.search(html, max(at, last + 1))
                data(html[at : cut.start()] if cut else html[at:])
                break
            if m.start() > at:
                data(html[at : m.start()])
            at, token = m.end(), m[0]
            name = _NAME.match(token)
            if name is None:
                continue
            tag = name[1].lower()
            if token[1] == "/":
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        close(k)
                        break
                    if stack[k][0] in ("article", "main", "body") and tag not in BLOCKS:
                        break
                continue
            if tag == "br":
                data(" ") if where is not None else None
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            if tag in RAW:
                end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(html, at) if tag != "svg" else re.compile("</svg\\s*>", re.I).search(html, at)
                at = end.end() if end else n
                continue
            if tag in BLOCKS:
                flush()
                for k in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][0] in _SCOPE:
                        break
            if tag in _ENDS:
                kinds, barrier = _ENDS[tag]
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in barrier:
                        break
                    if stack[k][0] in kinds:
                        close(k)
                        if tag != "tr":
                            break
            off, label = _marks(tag, token)
            inside = tag in ("article", "main") or bool(stack) and stack[-1][3]
            off = off or bool(stack) and stack[-1][2] or tag == "header" and not inside
            if not token.endswith("/>") or tag in BLOCKS:
                stack.append((tag, node_of(label), off, inside))
        flush()

    def skeleton(self) -> str:
        return "\x1f".join(f"{label}\x1e{parent}" for label, parent in self.tree)


def _read(skeleton: str) -> list[tuple[str, int]]:
    return [(x.partition("\x1e")[0], int(x.partition("\x1e")[2])) for x in skeleton.split("\x1f")] if skeleton else []


@lru_cache(maxsize=4096)
def aligned(page: str, wrapper: str) -> tuple[int, ...]:
    """Simple tree matching: for each node of the page's tree its node in the wrapper, or -1."""
    a, b = _read(page), _read(wrapper)
    if page == wrapper:
        return tuple(range(len(a)))
    below_a: list[list[int]] = [[] for _ in a]
    below_b: list[list[int]] = [[] for _ in b]
    for below, tree in ((below_a, a), (below_b, b)):
        for k, (_, parent) in enumerate(tree):
            if parent >= 0:
                below[parent].append(k)
    size: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def best(xs: list[int], ys: list[int]) -> tuple[int, list[tuple[int, int]]]:
        """Largest order-keeping matching of two lists of siblings."""
        table = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, x in enumerate(xs, 1):
            for j, y in enumerate(ys, 1):
                table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + size.get((x, y), (0,))[0])
        pairs, i, j = [], len(xs), len(ys)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                pairs.append((xs[i - 1], ys[j - 1]))
                i, j = i - 1, j - 1
        return table[-1][-1], pairs

    same: list[tuple[int, int]] = []  # nodes that may be matched: their ancestors have the same labels
    paths: dict[int, list[int]] = {-1: [-1]}
    tops: dict[tuple[int, str], int] = {(p, label): k for k, (label, p) in enumerate(b)}
    for x, (label, p) in enumerate(a):
        paths[x] = [y for q in paths[p] if (y := tops.get((q, label))) is not None]
        same += [(x, y) for y in paths[x]]
    for x, y in reversed(same):  # children come after their parents
        total, pairs = best([k for k in below_a[x] if paths[k]], below_b[y])
        size[x, y] = (total + 1, pairs)
    out = [-1] * len(a)
    todo = best([k for k, (_, p) in enumerate(a) if p < 0], [k for k, (_, p) in enumerate(b) if p < 0])[1]
    while todo:
        x, y = todo.pop()
        out[x] = y
        todo += size[x, y][1]
    return tuple(out)


def content(tree: list[tuple[str, int]], weight: list[float]) -> list[bool]:
    """Per node of the tree whether its blocks are content; weight: of each node's own blocks."""
    n = len(tree)
    off, has_article = [False] * n, [False] * n

    def masses() -> list[float]:
        mass = [0.0 if off[k] else weight[k] for k in range(n)]
        for k in range(n - 1, -1, -1):
            parent = tree[k][1]
            if parent >= 0:
                mass[parent] += mass[k]
        return mass

    tag = [label.lstrip(MARKED).partition(".")[0] for label, _ in tree]
    mass = masses()
    total = sum(m for m, (_, parent) in zip(mass, tree, strict=True) if parent < 0)
    inner = [False] * n
    for k in range(n - 1, -1, -1):
        if tree[k][1] >= 0:
            inner[tree[k][1]] = True
        has_article[k] |= tag[k] in ("article", "main") and mass[k] > 0
        if has_article[k] and tree[k][1] >= 0:
            has_article[tree[k][1]] = True
    for k, (label, parent) in enumerate(tree):
        least = MOST * total if inner[k] else total  # a single block is believed, a part of the page only if it's small
        off[k] = parent >= 0 and off[parent] or label.startswith(MARKED) and not has_article[k] and mass[k] < least
    mass = masses()
    total = sum(m for m, (_, parent) in zip(mass, tree, strict=True) if parent < 0)
    below: list[list[int]] = [[] for _ in range(n)]
    in_article = [False] * n
    tops = []
    for k, (_, parent) in enumerate(tree):
        if parent >= 0:
            below[parent].append(k)
            in_article[k] = in_article[parent]
        if tag[k] in ("article", "main") and not off[k] and not in_article[k]:
            in_article[k] = True
            tops.append(k)
    if tops and sum(mass[k] for k in tops) >= ARTICLES * total:
        largest = max(mass[k] for k in tops)
        roots = [k for k in tops if mass[k] >= BESIDE * largest]
        within = [k for k in range(n) if tag[k] == "article" and not off[k] and in_article[k] and k not in tops and mass[k] >= MOST * largest]
        if len(roots) == 1 and within:  # an article within main
            roots = within[:1]
    else:
        roots = [k for k, (_, parent) in enumerate(tree) if parent < 0]
        while len(roots) == 1:
            held = [k for k in below[roots[0]] if below[k] and mass[k] >= MOST * mass[roots[0]]]
            if not held or weight[roots[0]] > 0:
                break
            roots = held[:1]
    kept = [False] * n
    for k in roots:
        kept[k] = True
    for k, (_, parent) in enumerate(tree):
        kept[k] = (kept[k] or parent >= 0 and kept[parent]) and not off[k]
    return kept


#: Bytes up to which a table about hosts, constant texts or blocks is sent to every executor; a larger one is joined by a shuffle.
SMALL_BYTES = 8 << 20
#: Parts in which a host's pages are joined with its wrapper where that is shuffled.
PARTS = 64


def _host(url: str | None) -> str:
    return (re.match(r"[a-z+.-]*://([^/?#]*)", url or "", re.I) or ["", ""])[1].lower()


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _keyed(pages: DataFrame) -> DataFrame:
    """page_id, url, html and a key that equal rows share."""
    return pages.select("page_id", "url", "html", F.xxhash64("url", "html", F.col("url").isNull(), F.col("html").isNull()).alias("key"))


def _parsed(pages: DataFrame) -> DataFrame:
    """key, host (its hash), skeleton and of each block its node, the hash of its text and its length."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared.slices(batches, "html"):
            found = [Page(x or "") for x in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                part.column("key"), pa.array([_hash(_host(u)) for u in part.column("url").to_pylist()], pa.int64()), pa.array([p.skeleton() for p in found], pa.string()),
                pa.array([[b[0] for b in p.blocks] for p in found], pa.list_(pa.int32())),
                pa.array([[_hash(b[1]) for b in p.blocks] for p in found], pa.list_(pa.int64())),
                pa.array([[len(b[1]) for b in p.blocks] for p in found], pa.list_(pa.int32())),
            ], ["key", "host", "skeleton", "nodes", "hashes", "sizes"])

    return shared.map_arrow(_keyed(pages).drop("page_id"), step, "key long, host long, skeleton string, nodes array<int>, hashes array<long>, sizes array<int>")


def _slots(rows: DataFrame) -> DataFrame:
    """key, at, host, page, slot (-1: the wrapper lacks it), text (hash of slot and text), size of every block."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                to = aligned(r["skeleton"], r["wrapper"])
                for at, (node, h, size) in enumerate(zip(r["nodes"], r["hashes"], r["sizes"], strict=True)):
                    slot = to[node] if node >= 0 else -1
                    out.append((r["key"], at, r["host"], r["page"], slot, _hash(f"{slot} {h}"), size))
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "at", "host", "page", "slot", "text", "size"])

    return shared.map_arrow(rows, step, "key long, at int, host long, page long, slot int, text long, size int")


def _plans(wrappers: DataFrame, weights: DataFrame, sizes: DataFrame, least: int) -> DataFrame:
    """host, wrapper and which of its slots are content (null: too few different pages to tell)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for wrapper, slots, n in zip(*(batch.column(c).to_pylist() for c in ("wrapper", "slots", "n_pages")), strict=True):
                tree, weight = _read(wrapper), {x["slot"]: x["weight"] for x in slots or ()}
                kept.append(content(tree, [weight.get(k, 0.0) for k in range(len(tree))]) if (n or 0) >= least else None)
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("wrapper"), pa.array(kept, pa.list_(pa.bool_()))], ["host", "wrapper", "kept"])

    rows = wrappers.join(weights, "host", "left").join(sizes, "host", "left").select("host", "wrapper", "slots", "n_pages")
    return shared.map_arrow(rows, step, "host long, wrapper string, kept array<boolean>")


def chosen(tree: list[tuple[str, int]], nodes: list[int], sizes: list[int], constant: set[int], to: tuple[int, ...], kept: list[bool] | None) -> list[int]:
    """Places of the blocks that aren't content; to and kept: the slots of the tree's nodes and whether they are content."""
    vary = [at for at in range(len(nodes)) if at not in constant]
    if kept is not None:
        good = [False] * (len(tree) + 1)  # the last: blocks outside of all elements
        for k, (_, parent) in enumerate(tree):
            good[k] = kept[to[k]] if to[k] >= 0 else parent >= 0 and good[parent]
        if any(good[nodes[at]] for at in vary):
            return [at for at in range(len(nodes)) if at in constant or not good[nodes[at]]]
    weight = [0.0] * len(tree)
    for at in vary:
        if nodes[at] >= 0:
            weight[nodes[at]] += sizes[at]
    good = [*content(tree, weight), not any(weight)]
    return [at for at in range(len(nodes)) if at in constant or not good[nodes[at]]]


def _dropped(rows: DataFrame) -> DataFrame:
    """key and places of the blocks that aren't content, of pages (with wrapper, kept and constant) that have such."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, gone = [], []
            for r in batch.to_pylist():
                out = chosen(_read(r["skeleton"]), r["nodes"], r["sizes"], set(r["constant"] or ()), aligned(r["skeleton"], r["wrapper"]), r["kept"])
                if out:
                    keys.append(r["key"])
                    gone.append(out)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], ["key", "gone"])

    return shared.map_arrow(rows.select("key", "skeleton", "nodes", "sizes", "constant", "wrapper", "kept"), step, "key long, gone array<int>")


def _hosted(rows: DataFrame, table: DataFrame, weight: Column) -> DataFrame:
    """A join with a written table by host; broadcast if its bytes (by weight) are counted to be few, else a host's rows are dealt to PARTS."""
    if _bytes(table, weight) <= SMALL_BYTES:
        return rows.join(F.broadcast(table), "host")
    parts = table.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return rows.withColumn("_part", F.pmod(F.xxhash64("key"), F.lit(PARTS)).cast("int")).join(parts, ["host", "_part"]).drop("_part")


def _bytes(table: DataFrame, weight: Column) -> int:
    return table.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]


def _joinable(table: DataFrame, weight: Column) -> DataFrame:
    """A written table, to be broadcast if its bytes (by weight) are counted to be few."""
    return F.broadcast(table) if _bytes(table, weight) <= SMALL_BYTES else table


def extracted(pages: DataFrame, share: float = 0.6, least: int = 3) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    share and least: of the host's different pages, and so many, must have a text in a slot for it to be template.
    """
    parsed = shared.materialize(_parsed(pages).withColumn("page", F.xxhash64("hashes")), "pages").where(F.size("nodes") > 0)
    trees = parsed.groupBy("host", "skeleton").agg(F.count(F.lit(1)).alias("n"))
    wrappers = shared.materialize(trees.groupBy("host").agg(F.max_by("skeleton", F.struct("n", "skeleton")).alias("wrapper")), "wrappers")
    slots = shared.materialize(_slots(_hosted(parsed, wrappers, F.length("wrapper") + 16)), "slots")
    sizes = parsed.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    cell = ["host", "text"]
    often = shared.materialize(slots.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select(*cell), "often")
    seen = slots.select(*cell, "page").join(_joinable(often, F.lit(24)), cell).distinct().groupBy(*cell).agg(F.count(F.lit(1)).alias("on_pages"))
    constant = seen.join(sizes, "host").where(F.col("on_pages") >= F.greatest(share * F.col("n_pages"), F.lit(least))).select(*cell)
    constant = shared.materialize(constant, "constant")
    vary = slots.where("slot >= 0").join(_joinable(constant, F.lit(24)), cell, "left_anti").groupBy(*cell, "slot").agg(F.max("size").alias("size"))
    weights = vary.groupBy("host", "slot").agg(F.sum("size").cast("double").alias("weight")).groupBy("host").agg(F.collect_list(F.struct("slot", "weight")).alias("slots"))
    plans = shared.materialize(_plans(wrappers, weights, sizes, least), "plans")
    fixed = slots.join(_joinable(constant, F.lit(24)), cell, "left_semi").groupBy("key").agg(F.collect_set("at").alias("constant"))
    fixed = shared.materialize(fixed, "fixed")
    rows = _hosted(parsed, plans, F.length("wrapper") + F.size("kept") + 24).join(_joinable(fixed, 4 * F.size("constant") + 24), "key", "left")
    gone = shared.materialize(_dropped(rows).dropDuplicates(["key"]), "gone")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared.slices(batches, "html"):
            texts = [main_text(Page(x or ""), set(g or ())) for x, g in zip(part.column("html").to_pylist(), part.column("gone").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = _keyed(pages).join(_joinable(gone, 4 * F.size("gone") + 24), "key", "left").select("page_id", "url", "html", "gone")
    return shared.map_arrow(rows, step, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")


def main_text(page: Page, gone: set[int]) -> str:
    """The blocks that are content, in page order."""
    return "\n".join(text for at, (_, text) in enumerate(page.blocks) if at not in gone)
