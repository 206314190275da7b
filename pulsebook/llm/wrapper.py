"""Main text of web pages by wrapper induction.

The pages of a host are made of one template. Their trees are aligned by simple tree matching: two nodes match if
they have the same tag, class and id, and the children of matching nodes are matched in order so that as many nodes
as possible agree. Siblings of one kind are one node, so a node has one child of a kind, and matching its children is
the heaviest rising sequence of their places: exact for any width and depth, without a table.

A host's wrapper is the merged tree of all its different pages. Trees of one shape are merged once, the most frequent
first, in groups, groups of groups, and then the host. A node is in the wrapper if at least one in ``RARE`` of the host's
different pages has it, by a count over all of them: so a wrapper is at most ``RARE`` times as large as a page, and what
stays out could not be template, which takes half of the pages. All pages are then aligned to it, and what its nodes
(slots) hold is counted in Spark tables: different pages, whether their texts agree, letters, letters in links, and those
outside links of nodes below that are not in the wrapper. Copies of a page count once. From that follows per host

* what is template: a slot of one text on all pages that have it, which are at least LEAST_PAGES and half of the host's (but headings inside the article stay);
* where the article is: from the root down, as long as one child holds ``SHARE`` of what varies outside links, no
  headline stands beside it, and it is more than a run of blocks.

Where that finds no part of the page - on hosts of few pages, or without one main part - the article or main element
counts, and where there is none either, all that is not marked as something else by tag, role, class or id. Marked parts
inside the article are left out in any case; marks on what holds the article do not count.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsebook.llm.common import query, slices, stage, table

# A node that fewer than one in RARE of a host's pages have is not in its wrapper; share of the varying text that the article's part holds.
RARE, SHARE = 8, 0.8
# Groups in which a host's trees are merged, then groups of these.
GROUPS = (4096, 64, 1)
# Different pages that must agree in a text before it counts as template.
LEAST_PAGES = 4

_TAG = re.compile(
    r"""<(?:(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+(?=>)|[^>]*+)>|!--.*?(?:-->|\Z)|[!?/][^>]*+>)""", re.S
)
# One attribute, its name whole, with its value, so that nothing is looked for inside values.
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Elements of the markup language by what they mean for a text.
RAW = frozenset("script style noscript template textarea iframe svg math object canvas video audio title select xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "html body head main article section nav header footer aside form div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table "
    "thead tbody tfoot tr td th caption blockquote pre figure figcaption address details summary fieldset legend "
    "dialog menu button label center hgroup search option".split()
)
OTHER_TAGS = frozenset("nav footer aside head menu dialog button label search option".split())
# Elements that are content whatever their class is called.
CONTENT = frozenset("html body main article figure figcaption table blockquote pre h1 h2 h3 h4 h5 h6".split())
# Elements that name what follows: the same on every page ("Ingredients"), they still belong to the article they are in.
LABELS = frozenset("h1 h2 h3 h4 h5 h6 th dt caption".split())
CLOSES_P = BLOCKS - {"button", "label", "option"}
ROLES = frozenset("navigation contentinfo complementary search dialog alert alertdialog form menu menubar banner toolbar".split())
# Words of class names and ids that mark what is not the article.
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription sidebar widget widgets related recommended "
    "share sharing social comment comments disqus reply replies respond breadcrumb breadcrumbs menu nav navbar "
    "navigation pagination pager footer login signup search copyright toolbar".split()
)
HEAD_WORDS = frozenset("header masthead banner topbar".split())



class Node:
    """All siblings of one kind: their children by kind, their texts, the letters of those in links."""

    __slots__ = ("kind", "kids", "texts", "linked", "other", "depth", "slot")

    def __init__(self, kind: str, depth: int):
        self.kind, self.depth = kind, depth
        self.kids: dict[str, Node] = {}
        self.texts: list[str] = []
        self.linked, self.other, self.slot = 0, False, -1


class Block(NamedTuple):
    """A text with its node and the depths of what it is in (0: in none): the innermost marked element, header and
    form, the outermost article or main element."""

    text: str
    node: Node
    marked: int
    head: int
    form: int
    article: int


class Page:
    """The text blocks of a page, in order, and its tree."""

    def __init__(self, source: str):
        self.blocks: list[Block] = []
        self.root = Node("", 0)
        self.open: list[tuple] = [("", self.root, 0, 0, 0, 0)]
        self.run: list[str] = []
        self.link, self.linked = False, 0
        self._read(source)

    def _add(self, text: str) -> None:
        self.run.append(text)
        if self.link:
            self.linked += len(text)

    def _read(self, source: str) -> None:
        # Without a closing bracket further on nothing is a tag, but for a comment that the page's end cuts off.
        at, n, last = 0, len(source), max(source.rfind(">"), source.rfind("<!--") + 3)
        while at < n:
            found = _TAG.search(source, at, last + 1) if at <= last else None
            if not found:
                rest = source[at:]
                # A tag that the end of the page cut off is no text.
                cut = re.search("<[/!?a-zA-Z]", rest)
                self._add(rest[: cut.start()] if cut else rest)
                break
            if found.start() > at:
                self._add(source[at : found.start()])
            at = found.end()
            tag = found[2]
            if not tag:
                continue
            tag = tag.lower()
            if tag == "a":
                self.link = not found[1]
            elif found[1]:
                if tag in BLOCKS:
                    self._close(tag)
            elif tag in RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(source, at) if not found[3].endswith("/") else found
                at = max(at, end.end()) if end else n
                if tag != "title":
                    self.run.append(" ")
            elif tag in BLOCKS:
                self._start(tag, found[3])
            elif tag in VOID:
                self.run.append(" ")
        self._flush()

    def _flush(self) -> None:
        if self.run:
            text = "".join(self.run)
            self.run = []
            text = " ".join(html.unescape(text).split())
            if text:
                _, node, *places = self.open[-1]
                node.texts.append(text)
                node.linked += min(self.linked, len(text))
                self.blocks.append(Block(text, node, *places))
            self.linked = 0

    def _close(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self._flush()
                del self.open[i:]
                return

    def _start(self, tag: str, attributes: str) -> None:
        self._flush()
        if tag in CLOSES_P and self.open[-1][0] == "p":
            self.open.pop()
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
            if self.open[-1][0] in same:
                self.open.pop()
        _, parent, marked, head, form, article = self.open[-1]
        depth = parent.depth + 1
        words, names, other, top, main = set(), {}, tag in OTHER_TAGS, tag == "header", tag in ("article", "main")
        if attributes.strip():
            for kind, *values in _ATTRIBUTE.findall(attributes):
                kind, value = kind.lower(), next((v for v in values if v), "")
                if kind == "hidden" or kind == "aria-hidden" and value.lower() == "true":
                    other = True
                elif kind == "role":
                    role = value.lower()
                    top |= role == "banner"
                    other |= role in ROLES and role != "banner"
                    main |= role in ("main", "article")
                elif kind in ("class", "id"):
                    words.update(w.lower() for w in _PART.findall(value))
                    names[kind] = re.sub(r"\d+", "#", value)
        if tag in CONTENT:
            names = {}
        else:
            other |= not words.isdisjoint(OTHER_WORDS)
            top |= not words.isdisjoint(HEAD_WORDS)
        kind = ".".join([tag, *(f"{k}={v}" for k, v in sorted(names.items()) if v)])
        node = parent.kids.get(kind)
        if node is None:
            node = parent.kids[kind] = Node(kind, depth)
        node.other |= other or tag == "form"
        self.open.append((
            tag, node, depth if other else marked, depth if top else head, depth if tag == "form" else form,
            article or (depth if main else 0),
        ))


def heaviest(places: list[int], weights: list[int]) -> tuple[int, list[int]]:
    """Greatest weight of a rising sequence of places, and the indices it takes."""
    if all(a < b for a, b in zip(places, places[1:])):
        return sum(weights), list(range(len(places)))
    size = max(places) + 1
    tree, before = [(0, -1)] * (size + 1), [-1] * len(places)
    for i, (p, w) in enumerate(zip(places, weights)):
        best, k = (0, -1), p
        while k:
            best, k = max(best, tree[k]), k & (k - 1)
        before[i], mine, k = best[1], (best[0] + w, i), p + 1
        while k <= size:
            tree[k], k = max(tree[k], mine), k + (k & -k)
    best, k = (0, -1), size
    while k:
        best, k = max(best, tree[k]), k & (k - 1)
    out, i = [], best[1]
    while i >= 0:
        out.append(i)
        i = before[i]
    return best[0], out[::-1]


def matched(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching: the pairs of nodes of two trees that agree, parents before children."""
    found, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        found.append((x, y))
        todo += [(c, y.kids[k]) for k, c in x.kids.items() if k in y.kids]
    # Below every pair before the pair itself: nodes that agree there, and the children that do.
    worth: dict[int, int] = {}
    taken: dict[int, list] = {}
    for x, y in reversed(found):
        if not x.kids or not y.kids:
            worth[id(x)], taken[id(x)] = 1, []
            continue
        place = {k: i for i, k in enumerate(y.kids)}
        both = [(c, y.kids[k]) for k, c in x.kids.items() if k in place]
        weight, chosen = heaviest([place[d.kind] for _, d in both], [worth[id(c)] for c, _ in both])
        worth[id(x)], taken[id(x)] = 1 + weight, [both[i] for i in chosen]
    out, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        todo += taken[id(x)]
    return out


def merge(wrapper: Node, page: Node) -> None:
    """Take a page's tree into a wrapper; nodes in another order than the wrapper's stay out."""
    for x, y in matched(wrapper, page):
        new = [k for k in y.kids if k not in x.kids]
        if new:
            order, kids = list(x.kids), {**y.kids, **x.kids}
            at = 0
            for k in y.kids:
                if k in x.kids:
                    at = order.index(k) + 1
                else:
                    order.insert(at, k)
                    at += 1
            x.kids = {k: kids[k] for k in order}


def flat(wrapper: Node) -> str:
    """A wrapper as text: kinds and parents of its nodes, parents first."""
    kinds, parents, todo = [], [], [(wrapper, -1)]
    while todo:
        node, parent = todo.pop()
        at = len(kinds)
        kinds.append(node.kind)
        parents.append(parent)
        todo += [(c, at) for c in reversed(node.kids.values())]
    return json.dumps([kinds, parents])


@lru_cache(maxsize=256)
def tree(text: str) -> list[Node]:
    """The nodes of a wrapper by slot."""
    nodes: list[Node] = []
    for slot, (kind, parent) in enumerate(zip(*json.loads(text))):
        node = Node(kind, nodes[parent].depth + 1 if nodes else 0)
        node.slot = slot
        if nodes:
            nodes[parent].kids[kind] = node
        nodes.append(node)
    return nodes


def grown(shape: str, kept: set[int] | None = None) -> Node:
    """The tree of a flat text, or what of it is in ``kept``."""
    kinds, parents = json.loads(shape)
    nodes: list[Node | None] = []
    for kind, parent, print_ in zip(kinds, parents, paths(kinds, parents)):
        above = nodes[parent] if nodes else None
        if nodes and (above is None or kept is not None and print_ not in kept):
            nodes.append(None)
            continue
        node = Node(kind, above.depth + 1 if above else 0)
        if above:
            above.kids[kind] = node
        nodes.append(node)
    return nodes[0]


def paths(kinds: list[str], parents: list[int]) -> list[int]:
    """A print of each node's kinds from the root down."""
    out: list[int] = []
    for kind, parent in zip(kinds, parents):
        out.append(xxhash.xxh3_64_intdigest(kind, out[parent] if out else 0) >> 1)
    return out


def align(wrapper: str, page: Page) -> dict[int, Node]:
    """The page's nodes by their slots of the wrapper."""
    out = {}
    for x, y in matched(tree(wrapper)[0], page.root):
        y.slot = x.slot
        out[x.slot] = y
    return out


def unaligned(node: Node) -> int:
    """Letters outside links below a node, in nodes that have no slot and are not marked as something else."""
    letters, todo = 0, [c for c in node.kids.values() if c.slot < 0 and not c.other]
    while todo:
        x = todo.pop()
        letters += sum(map(len, x.texts)) - x.linked
        todo += [c for c in x.kids.values() if not c.other]
    return letters


def decided(wrapper: str, slots: list[dict]) -> tuple[int, list[int]]:
    """The slot of the article's part (0: none) and the slots of the template, from what was counted per slot."""
    kinds, parents = json.loads(wrapper)
    seen = {s["slot"]: s for s in slots}
    pages = seen[0]["pages"] if 0 in seen else 0
    fixed = [i for i, s in seen.items() if s["one"] and s["chars"] and s["pages"] >= max(LEAST_PAGES, pages / 2)]
    if pages < LEAST_PAGES:
        return 0, []
    still, n = set(fixed), len(kinds)
    tags = [k.split(".", 1)[0] for k in kinds]
    holds = [t in ("article", "main", "h1") for t in tags]
    kids: list[list[int]] = [[] for _ in kinds]
    for i in range(n - 1, 0, -1):
        holds[parents[i]] |= holds[i]
        kids[parents[i]].append(i)
    text = [0 if i in still or i not in seen else seen[i]["chars"] - seen[i]["linked"] for i in range(n)]
    titles = [tags[i] in ("h1", "h2") and text[i] > 0 for i in range(n)]
    for i, s in seen.items():
        text[i] += s["rest"]
    for i in range(n - 1, 0, -1):
        if i in seen and seen[i]["other"] and not holds[i]:
            text[i], titles[i] = 0, False
        text[parents[i]] += text[i]
        titles[parents[i]] |= titles[i]
    at = 0
    while kids[at] and tags[at] not in ("article", "main"):
        best = max(kids[at], key=lambda i: (text[i], -i))
        if not kids[best] or not text[best] or text[best] < SHARE * text[at] or any(titles[i] for i in kids[at] if i != best):
            break
        at = best
    part = at if tags[at] not in ("", "html", "body") else 0
    inside = [False] * n
    for i in range(1, n):
        inside[i] = inside[parents[i]] or i == part or tags[i] in ("article", "main")
    return part, [i for i in fixed if not (inside[i] and tags[i] in LABELS)]


def main_text(source: str | None, wrapper: str | None, part: int = 0, fixed: Iterable[int] = ()) -> str:
    """The page's article, with its host's wrapper, article slot and template slots if there are any."""
    return "\n".join(chosen(source, wrapper, part, fixed)[1])


def chosen(source: str | None, wrapper: str | None, part: int = 0, fixed: Iterable[int] = ()) -> tuple[str, list[str]]:
    """What decided - "wrapper", "article" or "marks" - and the texts."""
    page = Page(source or "")
    slots = align(wrapper, page) if wrapper else {}
    fixed = set(fixed)
    blocks = [b for b in page.blocks if b.node.slot not in fixed]
    if part and part in slots:
        top, inside, todo = slots[part].depth, set(), [slots[part]]
        while todo:
            node = todo.pop()
            inside.add(id(node))
            todo += node.kids.values()
        own = [b.text for b in blocks if id(b.node) in inside and b.marked <= top and b.form <= top]
        if own:
            return "wrapper", own
    article = [b for b in blocks if b.article]
    own = [b.text for b in article if not b.marked and b.form <= b.article] or [
        b.text for b in article if b.marked <= b.article and b.form <= b.article
    ]
    if article:
        return "article", own
    return "marks", [b.text for b in blocks if not (b.marked or b.head or b.form)]


def _shaped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tree of each page as text."""
    for batch in slices(batches):
        shapes = [flat(Page(source).root) for source in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("mark"), pa.array(shapes, pa.string())], names=["host", "mark", "shape"])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shape and node."""
    for batch in slices(batches):
        found = [paths(*json.loads(shape)) for shape in batch.column("shape").to_pylist()]
        of = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
        rows = [batch.column(c).take(of) for c in ("host", "pages")]
        rows += [pa.array([p for f in found for p in f], pa.int64()), pa.array([not i for f in found for i in range(len(f))], pa.bool_())]
        yield pa.RecordBatch.from_arrays(rows, names=["host", "pages", "path", "root"])


def _pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shapes without the nodes that few pages have."""
    for batch in slices(batches):
        shapes = [flat(grown(r["shape"], set(r["kept"]))) for r in batch.select(["shape", "kept"]).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(shapes, pa.string()), batch.column("pages")], names=["host", "shape", "pages"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One tree per group, from the most frequent shape on."""
    for batch in slices(batches):
        texts = []
        for shapes in batch.column("shapes").to_pylist():
            first, *others = sorted(shapes, key=lambda s: (-s["pages"], s["shape"]))
            whole = grown(first["shape"])
            for s in others:
                merge(whole, grown(s["shape"]))
            texts.append(flat(whole) if others else first["shape"])
        columns = [batch.column(c) for c in ("host", "group", "pages")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=["host", "group", "pages", "shape"])


_COUNTED = pa.schema([
    ("host", pa.string()), ("mark", pa.int64()), ("slot", pa.int32()), ("text", pa.int64()),
    ("chars", pa.int64()), ("linked", pa.int64()), ("other", pa.bool_()), ("rest", pa.int64()),
])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per page and slot that it fills."""
    for batch in slices(batches):
        rows = []
        for r in batch.to_pylist():
            for slot, node in align(r["wrapper"], Page(r["html"])).items():
                text = xxhash.xxh3_64_intdigest("\n".join(node.texts)) >> 1
                rows.append((r["host"], r["mark"], slot, text, sum(map(len, node.texts)), node.linked, node.other, unaligned(node)))
        columns = list(zip(*rows)) if rows else [()] * len(_COUNTED)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _COUNTED)], schema=_COUNTED)


def _ruled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rules = [decided(w, s) for w, s in zip(batch.column("wrapper").to_pylist(), batch.column("slots").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("wrapper"), pa.array([r[0] for r in rules], pa.int32()), pa.array([r[1] for r in rules], pa.list_(pa.int32()))],
            names=["host", "wrapper", "part", "fixed"],
        )


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [
            chosen(r["html"], r["wrapper"], r["part"] or 0, r["fixed"] or ())
            for r in batch.select(["html", "wrapper", "part", "fixed"]).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("url"), pa.array(["\n".join(t) for _, t in found], pa.string()), pa.array([by for by, _ in found], pa.string())],
            names=["key", "url", "text", "decided_by"],
        )


def wrappers(rows: DataFrame) -> DataFrame:
    """``host``, ``wrapper``, ``part``, ``fixed`` of the pages (``host``, ``html``), one row per host."""
    pages = rows.select("host", "html").where("host != '' and html != ''").withColumn("mark", F.xxhash64("html"))
    # The shape follows from the page, so copies of a page have one.
    shaped = pages.mapInArrow(_shaped, "host string, mark long, shape string").groupBy("host", "mark").agg(F.min("shape").alias("shape"))
    shapes = stage(shaped.groupBy("host", "shape").agg(F.count("*").alias("pages")), "shapes")
    nodes = shapes.mapInArrow(_paths, "host string, pages long, path long, root boolean")
    found = nodes.groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.max("root").alias("root"))
    whole = found.where("root").select("host", F.col("pages").alias("of"))
    kept = found.join(whole, "host").where(F.col("pages") * RARE >= F.col("of")).groupBy("host").agg(F.collect_list("path").alias("kept"))
    merged = shapes.join(kept, "host").mapInArrow(_pruned, "host string, shape string, pages long").groupBy("host", "shape").agg(F.sum("pages").alias("pages"))
    merged = merged.withColumn("group", F.xxhash64("shape"))
    for groups in GROUPS:
        merged = (
            merged.withColumn("group", F.pmod("group", F.lit(groups))).groupBy("host", "group")
            .agg(F.collect_list(F.struct("pages", "shape")).alias("shapes"), F.sum("pages").alias("pages"))
            .mapInArrow(_merged, "host string, group long, pages long, shape string")
        )
    made = stage(merged.select("host", F.col("shape").alias("wrapper")), "wrappers")
    counted = pages.join(made, "host").mapInArrow(
        _counted, "host string, mark long, slot int, text long, chars long, linked long, other boolean, rest long"
    )
    slots = counted.distinct().groupBy("host", "slot").agg(
        F.count("*").alias("pages"), (F.min("text") == F.max("text")).alias("one"),
        F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.max("other").alias("other"),
        F.sum("rest").alias("rest"),
    )
    listed = slots.groupBy("host").agg(F.collect_list(F.struct("slot", "pages", "one", "chars", "linked", "other", "rest")).alias("slots"))
    return stage(listed.join(made, "host").mapInArrow(_ruled, "host string, wrapper string, part int, fixed array<int>"), "rules")


def extract(df: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """``key``, ``url``, ``text`` and ``decided_by`` (wrapper, article or marks): one row per input row.

    Null and empty pages have an empty text. Pages without a host, and hosts with fewer than LEAST_PAGES different
    pages, have no wrapper; there the article element and the marks of tags, roles, classes and ids count. Copies of a
    page count once, so a template is not learnt from copies; repeated rows give equal texts. Pages of any length, depth
    and width are read whole. An empty table gives an empty result; other columns are ignored, whatever their names.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = df.select(F.col(key).alias("key"), F.col(url).alias("url"), host.alias("host"), F.col(source).alias("html"))
    kind = dict(rows.dtypes)["key"]
    return rows.join(wrappers(rows), "host", "left").select("key", "url", "html", "wrapper", "part", "fixed").mapInArrow(
        _extracted, f"key {kind}, url string, text string, decided_by string"
    )


@query("op2_wrapper_extraction")
def op2_wrapper_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's main text."""
    return extract(table(spark, folder, "pages")).select(
        F.col("key").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
