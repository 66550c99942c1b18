"""Main text of web pages by wrapper induction: what a host's pages share is template, what varies is content.

The trees of all pages of a host are aligned by simple tree matching into one tree, its wrapper: two elements can match if
they have the same label (tag, and the words of class and id), and the children of matched elements are matched in order so that
most elements match.  Neighbours of one label are one repeated node.  Each text of a page then stands in a slot, a
node of the wrapper.  A text that stands in a slot on nearly all pages that have the slot is constant, part of the
template; the other texts of the slots vary.  Of what varies, the article counts: the ``article`` element, else
``main``, else the deepest node of the wrapper that holds nearly all varying text outside links on the host's pages.  Menus,
adverts and the like vary from page to page too, so elements that call themselves such are left out.

Tasks align the pages that they have into partial wrappers, of which a host has as many as tasks saw it; these are
aligned in rounds of some 32, so no task gets the pages or all partial wrappers of a host.  Texts are counted by Spark, a page
that stands on a host several times once.  Pages move only if the wrappers are too large to be broadcast.
"""

from __future__ import annotations

import hashlib
import json
from collections import OrderedDict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topiclake.llm import dom
from topiclake.llm.dom import Block, Element
from topiclake.llm.tables import BROADCAST_ROWS, let_workers_import, written
from topiclake.llm.urls import host_and_path

#: a text is constant on this share of the pages that have its slot ...
CONSTANT = 0.8
#: ... if they are as many
LEAST_PAGES = 5
#: the part of the varying text that the main node holds
MAIN = 0.8
#: children of a node by label; where there are more, they are told apart by their tags alone
WIDE = 64
#: nodes of partial wrappers that a task keeps before it gives them away
KEPT_NODES = 200_000
#: partial wrappers that are aligned at once, about
MERGED = 32
BROADCAST_BYTES = 64 << 20

# fixed values: elements, roles and words of class and id that are no main text
NO_TEXT = set(
    """applet audio aside button canvas datalist dialog embed footer form head iframe input map menu nav noembed noframes noscript object
    script select style svg template textarea title video xmp""".split()
)
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
WORDS = set(
    """ad adbox ads adsense adslot advert advertisement advertisements advertising adverts alert alerts aside banner breadcrumb breadcrumbs
    consent cookie cookies crumbs foot footer gdpr hidden lightbox login masthead menu menus modal nav navbar navi navigation newsletter
    notice notices notification overlay pager pagination paywall popular popup popups promo promoted promotion rail recommendations
    recommended related share sharebar shares sharing sidebar sidebars signup skip social sponsor sponsored sponsors submenu subscribe
    subscription teaser teasers toolbar topbar trending widget widgets""".split()
)
COMMENTS = set("comment comments commentlist discussion disqus replies reply respond responses".split())
#: words that make a ``header`` one of the article
OWN = set("article content entry headline post story title".split())


def _article(e: Element) -> bool:
    return e.tag == "article" and not e.words & COMMENTS


def _main(e: Element) -> bool:
    return e.tag == "main" or e.attributes.get("role") == "main" or e.attributes.get("itemprop") == "articleBody"


def _inside(e: Element) -> Iterator[Element]:
    """All elements in an element, in no order."""
    todo = [e]
    while todo:
        for kid in todo.pop().kids:
            if not isinstance(kid, str):
                yield kid
                todo.append(kid)


def _around_main(e: Element) -> bool:
    """Whether an element is around the main text, whatever it calls itself."""
    tags = [(x.tag, _article(x) or _main(x)) for x in _inside(e)]
    return any(main for _, main in tags) or ("h1", False) in tags and tags.count(("p", False)) > 1


def unwanted(e: Element, path: tuple[Element, ...]) -> bool:
    """Whether an element is no part of a page's main text by what it is or calls itself.

    An element around the main text is part of it, whatever its name, unless it cannot hold any.  Of the header of an
    article the headings are.
    """
    tag, words, more = e.tag, e.words, e.attributes
    if tag in NO_TEXT:
        return tag != "form" or not _around_main(e)
    if path[-1].tag == "header" and tag not in dom.HEADINGS and not any(x.tag in dom.HEADINGS for x in _inside(e)):
        return True
    if tag == "header" or "header" in words and not words & OWN:
        return not any(_article(x) or _main(x) for x in path) and not any(_article(x) or _main(x) for x in _inside(e))
    if tag in ("body", "main") or not words and not more:
        return False
    style = more.get("style", "").replace(" ", "").lower()
    if "display:none" in style or "visibility:hidden" in style:
        return True
    if "hidden" in more or more.get("aria-hidden") == "true" or more.get("role") in ROLES:
        return not _around_main(e)
    if words & COMMENTS and not (tag == "article" and words & OWN):
        return not any(x.tag in ("h1", "main") for x in _inside(e))
    return bool(words & WORDS) and not _article(e) and not _around_main(e)


class Shape:
    """A node of a wrapper, or of a page that is being aligned: then ``members`` are its elements."""

    __slots__ = ("label", "wide", "kids", "members", "slot")

    def __init__(self, label: str, kids: list[Shape] | None = None, wide: bool = False, members: list[Element] | None = None) -> None:
        self.label, self.kids, self.wide, self.members, self.slot = label, kids or [], wide, members or [], -1

    def plain(self) -> list:
        return [self.label, int(self.wide), [k.plain() for k in self.kids]]

    @staticmethod
    def of(plain: list) -> Shape:
        return Shape(plain[0], [Shape.of(k) for k in plain[2]], bool(plain[1]))

    def size(self) -> int:
        return 1 + sum(k.size() for k in self.kids)

    def settled(self) -> Shape:
        if not self.wide and len(self.kids) > WIDE:
            self.wide, self.kids = True, _widened(self.kids)
        return self

    def number(self, at: int = 0) -> int:
        """Give every node its slot, its place in page order."""
        self.slot = at
        at += 1
        for kid in self.kids:
            at = kid.number(at)
        return at


def shape_of(e: Element) -> Shape:
    """An element and the block elements in it; neighbours of one label become one node."""
    kids: list[Shape] = []
    todo = list(reversed(e.kids))
    while todo:
        kid = todo.pop()
        if isinstance(kid, str):
            continue
        if kid.tag not in dom.BLOCKS:
            todo.extend(reversed(kid.kids))
        elif kid.tag not in ("hr", "head"):
            kids.append(shape_of(kid))
    return Shape(e.label, _narrow(kids), members=[e]).settled()


def _narrow(kids: list[Shape]) -> list[Shape]:
    out: list[Shape] = []
    for kid in kids:
        if out and out[-1].label == kid.label:
            merge(out[-1], kid)
        else:
            out.append(kid)
    return out


def _widened(kids: list[Shape]) -> list[Shape]:
    by_tag: dict[str, Shape] = {}
    for kid in kids:
        kid.label = kid.label.partition(".")[0]
        if kid.label in by_tag:
            merge(by_tag[kid.label], kid)
        else:
            by_tag[kid.label] = kid
    return list(by_tag.values())


def _matching(a: list[Shape], b: list[Shape], weight: Callable[[Shape, Shape], int]) -> list[tuple[int, int]]:
    """Pairs of places of children in order that together match most."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    pair = [[0] * len(b) for _ in a]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            if a[i].label == b[j].label:
                pair[i][j] = weight(a[i], b[j])
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + pair[i][j])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if pair[i][j] and best[i][j] == best[i + 1][j + 1] + pair[i][j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return out


def matched(a: Shape, b: Shape) -> list[tuple[int, int]]:
    """Simple tree matching of two nodes of one label: which children match."""
    known: dict[tuple[int, int], int] = {}

    def weight(x: Shape, y: Shape) -> int:
        """Elements that match in two trees whose roots do."""
        key = (id(x), id(y))
        if key not in known:
            if [k.label for k in x.kids] == [k.label for k in y.kids]:
                known[key] = 1 + sum(weight(p, q) for p, q in zip(x.kids, y.kids))
            else:
                known[key] = 1 + sum(weight(x.kids[i], y.kids[j]) for i, j in _matching(x.kids, y.kids, weight))
        return known[key]

    labels = [k.label for k in a.kids]
    if labels == [k.label for k in b.kids]:
        return [(i, i) for i in range(len(labels))]
    return _matching(a.kids, b.kids, weight)


def merge(a: Shape, b: Shape) -> None:
    """Align the tree ``b`` with ``a`` and put what has no match into ``a``, in order."""
    a.members += b.members
    if a.wide or b.wide:
        a.wide, a.kids = True, _widened(a.kids + b.kids)
        return
    out: list[Shape] = []
    i = j = 0
    for x, y in [*matched(a, b), (len(a.kids), len(b.kids))]:
        out += a.kids[i:x] + b.kids[j:y]
        if x < len(a.kids):
            merge(a.kids[x], b.kids[y])
            out.append(a.kids[x])
        i, j = x + 1, y + 1
    a.kids = _narrow(out)
    a.settled()


def place(page: Shape, wrapper: Shape, slots: dict[int, int]) -> None:
    """Find the slots of a page's elements in the wrapper: ``slots`` gets id(element) -> slot."""
    for e in page.members:
        slots[id(e)] = wrapper.slot
    if wrapper.wide and not page.wide:
        page.wide, page.kids = True, _widened(page.kids)
    if page.wide and not wrapper.wide:
        return
    if wrapper.wide:
        by_tag = {k.label: k for k in wrapper.kids}
        pairs = [(kid, by_tag[kid.label]) for kid in page.kids if kid.label in by_tag]
    else:
        pairs = [(page.kids[i], wrapper.kids[j]) for i, j in matched(page, wrapper)]
    for kid, node in pairs:
        place(kid, node, slots)


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _partial_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) -> a partial wrapper for each host a task has seen."""
    kept: dict[str, Shape] = {}
    seen: set[tuple[str, int]] = set()
    nodes = 0

    def given() -> pa.RecordBatch:
        out = {"host": list(kept), "wrapper": [json.dumps(w.plain(), separators=(",", ":")) for w in kept.values()]}
        kept.clear()
        seen.clear()
        return pa.RecordBatch.from_pydict({k: pa.array(v, pa.string()) for k, v in out.items()})

    for batch in batches:
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            shape = shape_of(dom.parse(html or ""))
            key = (host, hash(json.dumps(shape.plain())))
            if key in seen:  # the same shape changes nothing
                continue
            seen.add(key)
            shape = Shape.of(shape.plain())
            nodes += shape.size()
            if host in kept:
                merge(kept[host], shape)
            else:
                kept[host] = shape
            if nodes > KEPT_NODES:
                yield given()
                nodes = 0
    yield given()


def _joined(frames):
    """Partial wrappers of a host as one, a pandas group."""
    plain = sorted(set(frames["wrapper"]))
    first = Shape.of(json.loads(plain[0]))
    for other in plain[1:]:
        merge(first, Shape.of(json.loads(other)))
    out = frames.iloc[:1][["host"]].copy()
    out["wrapper"] = json.dumps(first.plain(), separators=(",", ":"))
    return out


def induce(pages: DataFrame) -> DataFrame:
    """(host, html) -> (host, wrapper): one for each host, from all its pages."""
    parts = written(pages.mapInArrow(_partial_wrappers, "host string, wrapper string"), "wrappers")
    while (most := parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        deal = F.pmod(F.xxhash64("wrapper", F.monotonically_increasing_id()), F.lit(-(-most // MERGED)))
        dealt = parts.withColumn("deal", deal).groupBy("host", "deal")
        parts = written(dealt.applyInPandas(_joined, "host string, wrapper string"), "wrappers")
    return parts


class _Wrappers:
    """The wrappers that a task has used last."""

    def __init__(self) -> None:
        self.kept: OrderedDict[str, tuple] = OrderedDict()

    def get(self, host: str, plain: str, make: Callable[[str], tuple]) -> tuple:
        if host not in self.kept:
            if len(self.kept) >= 256:
                self.kept.popitem(last=False)
            self.kept[host] = make(plain)
        self.kept.move_to_end(host)
        return self.kept[host]


def _read(html: str | None, wrapper: Shape) -> tuple[dict[int, int], list[tuple[Block, int]]]:
    """The slots of a page's elements, by id, and its blocks that are not unwanted with theirs; -1 where the wrapper has none."""
    root = dom.parse(html or "")
    slots: dict[int, int] = {}
    place(shape_of(root), wrapper, slots)
    return slots, [(b, slots.get(id(b.path[-1]), -1)) for b in dom.blocks(root, unwanted)]


def _wrapper(plain: str) -> tuple[Shape]:
    shape = Shape.of(json.loads(plain))
    shape.number()
    return (shape,)


_TEXTS = "host string, slot int, text bigint, page bigint, chars bigint"


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html, wrapper) -> the texts in slots, by hashes, and their characters outside links."""
    kept = _Wrappers()
    for batch in batches:
        for begin in range(0, len(batch), 256):
            rows: list[tuple] = []
            for r in batch.slice(begin, 256).to_pylist():
                (shape,) = kept.get(r["host"], r["wrapper"], _wrapper)
                _, found = _read(r["html"], shape)
                texts = [_hash(b.text) for b, _ in found]
                page = _hash(repr(texts))
                rows += {(r["host"], s, t, page): (len(b.text) - b.linked) for (b, s), t in zip(found, texts) if s >= 0}.items()
            columns = list(zip(*[(*k, v) for k, v in rows])) or [()] * 5
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "slot", "text", "page", "chars"])


def _main_node(plain: str, chars: dict[int, int]) -> int:
    """The deepest node that holds nearly all of ``chars`` (slot -> varying characters outside links)."""
    shape = Shape.of(json.loads(plain))
    shape.number()
    sums: dict[int, int] = {}

    def total(node: Shape) -> int:
        sums[node.slot] = chars.get(node.slot, 0) + sum(total(k) for k in node.kids)
        return sums[node.slot]

    whole, node = total(shape), shape
    while True:
        inner = [k for k in node.kids if whole and sums[k.slot] >= MAIN * whole]
        if not inner or inner[0].label.partition(".")[0] in ("p", "li", "td", "tr", "dd", "dt", "blockquote", "pre", *dom.HEADINGS):
            return node.slot
        node = inner[0]


def _models(frames):
    """(host, wrapper, slots), pandas frames, -> the wrapper of each host with its constant texts and main node."""
    for rows in frames:
        made = []
        for plain, slots in zip(rows["wrapper"], rows["slots"]):
            slots = slots if slots is not None else []
            main = _main_node(plain, {s["slot"]: s["varying"] for s in slots})
            constant = [[int(s["slot"]), int(t)] for s in slots for t in (s["constant"] if s["constant"] is not None else [])]
            made.append(json.dumps({"main": main, "constant": constant, "wrapper": plain}))
        yield rows[["host"]].assign(wrapper=made)


def _side(wrappers: DataFrame) -> DataFrame:
    """A written table of wrappers, marked for broadcast if its rows and bytes are few."""
    size = wrappers.agg(F.count("*").alias("n"), F.sum(F.octet_length("wrapper")).alias("bytes")).first()
    return F.broadcast(wrappers) if size["n"] <= BROADCAST_ROWS and (size["bytes"] or 0) <= BROADCAST_BYTES else wrappers


def learn(pages: DataFrame) -> DataFrame:
    """(host, html) -> (host, wrapper): the wrapper of each host with its constant texts and main node."""
    wrappers = induce(pages)
    texts = written(
        pages.join(_side(wrappers), "host").mapInArrow(_texts, _TEXTS).groupBy("host", "slot", "text", "page").agg(F.max("chars").alias("chars")),
        "slot-texts",
    )
    # of a page that is there several times the texts count once
    by_text = texts.groupBy("host", "slot", "text").agg(F.count("*").alias("pages"), F.sum("chars").alias("chars"))
    slots = texts.groupBy("host", "slot").agg(F.count_distinct("page").alias("slot_pages"), F.sum("chars").alias("varying"))
    often = by_text.where(F.col("pages") >= LEAST_PAGES)
    shared = often.join(slots.where(F.col("slot_pages") >= LEAST_PAGES).drop("varying"), ["host", "slot"]).where(F.col("pages") >= CONSTANT * F.col("slot_pages"))
    # few texts of a slot can each be on nearly all of its pages
    constant = shared.groupBy("host", "slot").agg(F.collect_list("text").alias("constant"), F.sum("chars").alias("fixed"))
    both = slots.join(constant, ["host", "slot"], "left")
    slot = F.struct("slot", (F.col("varying") - F.coalesce("fixed", F.lit(0))).alias("varying"), "constant")
    # a row for each node of a host's wrapper at most
    model = wrappers.join(both.groupBy("host").agg(F.collect_list(slot).alias("slots")), "host", "left")
    return written(model.mapInPandas(_models, "host string, wrapper string"), "host-wrappers")


def _model(plain: str) -> tuple[Shape, int, set[tuple[int, int]]]:
    model = json.loads(plain)
    return (*_wrapper(model["wrapper"]), model["main"], {(s, t) for s, t in model["constant"]})


def main_text(html: str | None, wrapper: Shape, main: int, constant: set[tuple[int, int]]) -> str:
    """The main text of a page by its host's wrapper."""
    slots, found = _read(html, wrapper)
    varying = [b for b, s in found if not constant or (s, _hash(b.text)) not in constant]
    outer: dict[int, list] = {}
    for b in varying:
        article = next((x for x in b.path if _article(x)), None)
        if article is not None:
            known = outer.setdefault(id(article), [article, b.path[: b.path.index(article)], 0, []])
            known[2] += len(b.text)
            known[3].append(b)
    if outer:
        largest = max(outer.values(), key=lambda o: o[2])
        # articles that stand beside the largest and look like it belong to it
        chosen = [b for o in outer.values() if o[1] == largest[1] and o[0].label == largest[0].label for b in o[3]]
    else:
        chosen = [b for b in varying if any(_main(x) for x in b.path)]
    if not chosen:
        inside = [b for b in varying if any(slots.get(id(x)) == main for x in b.path)]
        chosen = [b for b in inside or varying if 2 * b.linked <= len(b.text)]
    return "\n".join(b.text for b in chosen)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = _Wrappers()
    for batch in batches:
        for begin in range(0, len(batch), 256):
            part = batch.slice(begin, 256)
            rows = zip(*[part.column(c).to_pylist() for c in ("host", "html", "wrapper")])
            texts = [main_text(html, *kept.get(host, wrapper, _model)) for host, html, wrapper in rows]
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (url, html, any others) with ``text``, the main text of each, in place of a column of that name and of ``html``.

    NULL and empty pages, and pages without text, have an empty text.  Pages without a host (NULL url or one without ``://``) are
    pages of one host.  Repeated pages get a row each and count once for their host's wrapper, so a text is not template because its
    page was copied.  Hosts of fewer than 5 different pages have no constant texts.  Pages of any length are read whole; elements
    nested more than 120 deep stand in the 120th.  Other columns stay as they are, whatever their names.  An empty table gives an empty result.
    """
    let_workers_import(pages.sparkSession)
    host, _ = host_and_path(F.coalesce(F.col("url").cast("string"), F.lit("")))
    others = [c for c in pages.columns if c not in ("html", "text")]
    rows = pages.select(host.alias("host"), "html", F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"))
    models = learn(rows.select("host", "html"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.join(_side(models), "host").mapInArrow(_extract, f"row {kind}, text string").select("row.*", "text")
