from __future__ import annotations

import html as std_html
import json
import random
import re

import pytest

from topiclake.llm import dom, wrappers
from topiclake.llm.queries.pages import op13_html_extraction

FOLDER = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string"


def blocks(text):
    return [b.text for b in dom.blocks(dom.parse(text), lambda e, _: e.tag in ("script", "style", "head"))]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("", []),
        ("<p><b>A<br><p>B &amp; c&ampd &#x41;</p>x<script>var t='</p>'</script> y", ["A", "B & c&d A", "x y"]),
        ("<ul><li>a<li>b<ul><li>c</ul>d</ul><table><tr><td>1<td>2<tr><td>3</table>e", ["a", "b", "c", "d", "1", "2", "3", "e"]),
        ("a<div>b<span>c</div>d</span>e", ["a", "bc", "de"]),
        ("x < y <3 <a href='>'>z</a>", ["x < y <3 z"]),
        ('<p title="unclosed>abc', ["abc"]),
        ("<p>cut <b", ["cut"]),
        ("a<!-- <p>no</p> -->b<!DOCTYPE html><?php x ?>c<!-- open", ["abc"]),
        ("<head><title>t</title><p>in the body", ["in the body"]),
        ("<textarea><p>raw</textarea> b", ["b"]),
        ("<style>p{}</style><p>a\n\t b\xa0 c", ["a b c"]),
        ("<div>" * 3000 + "deep" + "</div>" * 3000 + "after", ["deep", "after"]),
        ("</p></div>a</h1>", ["a"]),
    ],
)
def test_blocks(text, want):
    assert blocks(text) == want


def test_long_pages_take_time_in_proportion():
    for part in ("<p>", "<a ", '<a "', "</p>", "<b>x", "<!-", "&", "<p a='"):
        blocks(part * 50_000)
    assert blocks("<p>" + "word " * 200_000) == [("word " * 200_000).strip()]


def random_shape(rng, depth):
    kids = [random_shape(rng, depth - 1) for _ in range(rng.randint(0, 3))] if depth else []
    return wrappers.Shape(rng.choice("ab"), wrappers._narrow(kids))


def test_tree_matching():
    """The weight of a matching against all ways to match children in order."""

    def best(a, b):
        if a.label != b.label:
            return 0

        def rest(i, j):
            if i == len(a.kids) or j == len(b.kids):
                return 0
            both = best(a.kids[i], b.kids[j])
            return max(rest(i + 1, j), rest(i, j + 1), both + rest(i + 1, j + 1) if both else 0)

        return 1 + rest(0, 0)

    def weight(a, b):
        return 1 + sum(weight(a.kids[i], b.kids[j]) for i, j in wrappers.matched(a, b))

    rng = random.Random(7)
    for _ in range(300):
        a, b = random_shape(rng, 3), random_shape(rng, 3)
        b.label = a.label
        if [k.label for k in a.kids] != [k.label for k in b.kids]:
            assert weight(a, b) == best(a, b)


def test_a_wrapper_has_a_place_for_every_page():
    rng = random.Random(11)
    for _ in range(100):
        pages = [random_shape(rng, 3) for _ in range(6)]
        for p in pages:
            p.label = "html"
        whole = wrappers.Shape.of(pages[0].plain())
        for p in pages[1:]:
            wrappers.merge(whole, wrappers.Shape.of(p.plain()))
        whole.number()
        labels = {}

        def note(node):
            labels[node.slot] = node.label
            for kid in node.kids:
                note(kid)

        note(whole)
        for p in pages:
            nodes = []

            def enter(node):
                node.members = [node]
                nodes.append(node)
                for kid in node.kids:
                    enter(kid)

            enter(p)
            slots = {}
            wrappers.place(p, whole, slots)
            assert all(labels[slots[id(n)]] == n.label for n in nodes if id(n) in slots)
            assert len(slots) >= 0.7 * len(nodes)


def words(rng, n):
    return " ".join(rng.choice("lorem ipsum dolor sit amet & consetetur <sadipscing> elitr é".split()) for _ in range(n))


def page(rng, kind, i):
    """A page and its main text."""
    esc = std_html.escape
    title, paragraphs = f"Title {i} {words(rng, 3)}", [f"{i} {words(rng, rng.randint(5, 60))}" for _ in range(rng.randint(1, 6))]
    links = "".join(f'<li><a href="/{rng.random()}">{esc(words(rng, 2))}</a></li>' for _ in range(4))
    noise = {
        "menu": f"<nav><ul>{links}</ul></nav>",
        "top": f"<header><div class='logo'>Site</div><h1>Site name</h1><ul>{links}</ul></header>",
        "ad": f'<div class="ad-box">{esc(words(rng, 20))}</div>',
        "cookies": "<div id=cookieNotice><p>We use cookies. <button>OK</button></div>",
        "side": f"<aside><h3>More</h3><ul>{links}</ul></aside>",
        "form": f"<form><p>{esc(words(rng, 6))}<input name=q><select><option>x</select></form>",
        "comments": f'<section id="comments"><h2>2 comments</h2><article class="comment"><p>{esc(words(rng, 80))}</article><p class=reply>{esc(words(rng, 40))}</section>',
        "foot": f"<footer>&copy; {i} {esc(words(rng, 5))}</footer>",
    }
    inner = f"<h1>{esc(title)}</h1>" + "".join(f"<p>{esc(p)}</p>" if rng.random() < 0.7 else f"<p><b>{esc(p)}<br>" for p in paragraphs)
    inner += f'<div class="share-buttons">Share {i}</div><script>var x = "<p>no</p>";</script>'
    if kind == "article":
        body = f"{noise['top']}{noise['menu']}{noise['cookies']}<main><article>{inner}</article>{noise['comments']}</main>{noise['side']}"
    elif kind == "main":
        body = f"{noise['menu']}{noise['ad']}<main>{inner}</main>{noise['form']}{noise['comments']}"
    else:  # no name says which part is the main text, and a box of the same words stands on every page
        body = f"<div class=x><p>Always the same words on all pages of this host.</p></div><div class=y><ul>{links}</ul></div><div class=z>{inner}</div>{noise['form']}"
    text = " ".join(title.split()) + "\n" + "\n".join(" ".join(p.split()) for p in paragraphs)
    return f"<!DOCTYPE html><html><head><title>{esc(title)}</title><style>p {{}}</style></head><body>{body}{noise['foot']}", text


@pytest.mark.parametrize("kind", ["article", "main", "plain"])
def test_a_site(spark, kind):
    rng = random.Random(3)
    made = [page(rng, kind, i) for i in range(40)]
    rows = [(i, f"https://{kind}.example/{i}", h) for i, (h, _) in enumerate(made)]
    rows += [(100 + i, f"https://{kind}.example/copy{i}", made[0][0]) for i in range(30)]  # copies are no template
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, PAGES).repartition(6)).collect()}
    assert [got[i] for i in range(40)] == [t for _, t in made]
    assert all(got[100 + i] == made[0][1] for i in range(30))


def test_notice_without_a_name(spark):
    """A sentence that stands in the article of nearly all pages of a host is template, copies of an article are not."""
    rows = [(i, "http://h/a", f"<article><p>Read this text of page {i}, please.</p><p>Call us now, lines are open.</p></article>") for i in range(9)]
    rows += [(20 + i, "http://copies/a", "<article><p>One text.</p><p>Copied.</p></article>") for i in range(9)]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[i] == f"Read this text of page {i}, please." for i in range(9))
    assert all(got[20 + i] == "One text.\nCopied." for i in range(9))


def test_odd_rows(spark):
    long = "<p>" + "word " * 100_000
    rows = [(1, None, "<p>no host</p>"), (2, "http://a/", None), (3, "http://a/", ""), (None, "http://a/", "<p>x</p>"), (None, "http://a/", "<p>x</p>"), (4, "http://b/", long), (5, "http://c/", "<nav>only a menu</nav>"), (6, "http://d", "<div>" * 5000 + "deep"), (7, "http://e", "&lt;b&gt;\x00")]
    df = spark.createDataFrame([(*r, "h", "r", "w", "t") for r in rows], PAGES + ", host string, row string, wrapper string, text string")
    found = wrappers.extract(df)
    assert found.columns == ["page_id", "url", "host", "row", "wrapper", "text"]
    got = sorted(((r.page_id or 0, r.text) for r in found.collect()))
    assert got == [(0, "x"), (0, "x"), (1, "no host"), (2, ""), (3, ""), (4, ("word " * 100_000).strip()), (5, ""), (6, "deep"), (7, "<b>\x00")]
    assert wrappers.extract(df.limit(0)).count() == 0


def test_many_partial_wrappers(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "MERGED", 2)
    rng = random.Random(5)
    made = [page(rng, "plain", i) for i in range(30)]
    rows = [(i, "http://h/", h) for i, (h, _) in enumerate(made)]
    df = spark.createDataFrame(rows, PAGES).repartition(12)
    found = wrappers.induce(df.selectExpr("'h' AS host", "html")).collect()
    assert len(found) == 1
    assert {r.page_id: r.text for r in wrappers.extract(df).collect()} == {i: t for i, (_, t) in enumerate(made)}


def test_children_without_end():
    e = dom.parse("".join(f"<div class='{chr(97 + i % 26)}{chr(97 + i // 26)}'>x</div><p>y" for i in range(400)))
    shape = wrappers.shape_of(e)
    assert shape.wide and sorted(k.label for k in shape.kids) == ["div", "p"]
    narrow = wrappers.shape_of(dom.parse("<p>a"))
    wrappers.merge(narrow, shape)
    assert narrow.wide and json.loads(json.dumps(narrow.plain())) == narrow.plain()


def plain(text):
    """The article of a page as the given tables write it."""
    m = re.search(r"<article>(.*?)(</article>|$)", text, re.S)
    parts = re.split(r"<(?:/?p|/?h1)>", m[1]) if m else []
    clean = [" ".join(std_html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
    return "\n".join(c for c in clean if c)


def test_query(spark):
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in op13_html_extraction(spark, FOLDER).collect()}
    rows = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert got == {r.page_id: (r.url, plain(r.html), len(plain(r.html))) for r in rows}
