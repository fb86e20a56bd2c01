"""Pages and embeddings next to brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from frostline.llm import cover_tree, html_template
from frostline.llm.common import Stages, table


def page(host, n, blocks, extra=""):
    body = "".join(f"<p>{b}" + ("</p>" if k % 2 else "") for k, b in enumerate(blocks))
    return (n, f"http://{host}/p/{n}", f"<!DOCTYPE html><html><head><title>t</title><script>var a='<p>x</p>';</script></head><body><header>Site</header>"
            f"<nav><ul><li><a href=/a>Menu {n}</a></ul></nav><!-- <p>no</p> --><div class='ad box'>Buy {n}</div><article><h1>Title&nbsp; {n}</h1>{body}"
            f"{extra}<section class=comments><p>first!</p></section></article><aside>Side</aside><form><p>Mail</p></form><footer>&copy; {n}</footer>")


def test_main_text_of_templates(spark):
    rows = [page("a.example", n, [f"One &amp; {n}\n two", "Three<br>four", "<b>five <i>six"], "<ul><li>x<li>y</ul><pre> k  l </pre>") for n in range(6)]
    got = {r.page_id: r.main_text for r in html_template.main_text(spark.createDataFrame(rows, "page_id int, url string, html string"), Stages(spark)).collect()}
    assert got == {n: f"Title {n}\nOne & {n} two\nThree four\nfive six\nx\ny\nk l" for n in range(6)}


def test_slot_without_a_name_is_the_one_with_text(spark):
    """Same-host pages of plain divs: the slot is found by its text outside links."""
    rows = [(n, "https://b.example/x", f"<body><div class=top><a href=1>{'link ' * 40}</a></div><div class=k1><p>{'words here ' * 12}{n}</p></div><div class=k2>end</div></body>") for n in range(4)]
    got = {r.page_id: r.main_text for r in html_template.main_text(spark.createDataFrame(rows, "page_id int, url string, html string"), Stages(spark)).collect()}
    assert got == {n: " ".join(["words here"] * 12) + f" {n}" for n in range(4)}


def test_equivalence_classes(spark):
    """Tokens that pages have equally often, and once, form the template; what repeats is left out."""
    rows = [(str(n), f"<html><body><article>{'<p>x</p>' * (n + 1)}</article><footer>f</footer></body></html>") for n in range(5)]
    [r] = html_template.templates(spark.createDataFrame(rows, "url string, html string").withColumn("host", F.lit("h"))).collect()
    assert r.paths == ["", "html", "html>body", "html>body>article", "html>body>footer"] and r.fixed == []


def main_texts(spark, rows):
    return {r.page_id: r.main_text for r in html_template.main_text(spark.createDataFrame(rows, "page_id int, url string, html string"), Stages(spark)).collect()}


def unnamed(n):
    """Two layouts without telling names or elements: menu and closing words are the host's, the rest varies."""
    words = f"Body of page {n} with words {n * n}."
    menu, end = f"<div id=a><p>{'Choose what to read here. ' * 9}</p></div>", f"<div id=z><p>{'All rights are reserved by us. ' * 9}</p></div>"
    if n % 3:
        return n, "http://plain/x", f"<html><body>{menu}<div id=b><h2>Head {n}</h2><div id=c><p>{words}</p><p>More {n}</p></div></div>{end}</body></html>"
    return n, "http://plain/x", f"<html><body>{menu}<div id=q><div id=r><p>{words}</p></div></div>{end}</body></html>"


def test_template_without_names(spark, monkeypatch):
    """What the pages of a host share is template, what varies is text; without occurrence vectors that is lost."""
    rows = [unnamed(n) for n in range(12)]
    text = {n: f"Head {n}\nBody of page {n} with words {n * n}.\nMore {n}" if n % 3 else f"Body of page {n} with words {n * n}." for n in range(12)}
    assert main_texts(spark, rows) == text
    plain = html_template.host_template

    def no_vectors(found):
        return plain([{**t, "v1": 0, "v2": 0} for t in found])

    vectors = [{"path": p, "v1": v, "v2": v, "in_pages": n, "once": n, "own": 9, "plain": 9, "text": 9, "links": 0, "same": False}
               for p, v, n in (("", 1, 9), ("html", 1, 9), ("html>div.a", 2, 5), ("html>div.b", 3, 4))]
    assert plain(vectors)[0] == ["", "html", "html>div.a", "html>div.b"] and no_vectors(vectors)[0] == []


def test_vectors_decide(spark):
    """The same pages with all vectors set to 0 lose their template, and so their texts."""
    rows = [unnamed(n) for n in range(12)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    [made] = html_template.templates(pages.withColumn("host", F.lit("plain"))).collect()
    known, fixed = dict(zip(made.paths, made.weights)), frozenset(made.fixed)
    with_them = [html_template.page_text(r[2], known, fixed) for r in rows]
    without = [html_template.page_text(r[2]) for r in rows]
    assert all(a != b for a, b in zip(with_them, without))


@pytest.mark.parametrize("page, text", [
    ("<article><p title=it's>First part.</p><p>Second part.</p><p>it's third</p></article>", "First part.\nSecond part.\nit's third"),
    ("<article class='post tag-search'><p>Real text of it.</p></article>", "Real text of it."),
    ("<article><p>One of them.</p><div class='related-work'><p>Others wrote.</p></div><div class='comment-list'><p>first!</p></div></article>", "One of them.\nOthers wrote."),
    ("<article><p data-x='a>b' class=k>In</p><!--><p>after</p><a href=x?a=\"b>link</a></article>", "In\nafter\nlink"),
    ("<main><div class=ad-slot>Buy</div><h1>Head</h1><p>Text</p></main>", "Head\nText"),
])
def test_marks_and_names(page, text):
    assert html_template.page_text(page) == text


def test_odd_pages_and_layouts(spark):
    """One page with a second article, and a second layout, do not turn pages into whole bodies."""
    top = "<div class=box>Notice to all {n}</div>"
    odd = [(n, "http://odd/x", f"<body>{top.format(n=n)}<article><p>text {n}</p></article>{'<article><p>two</p></article>' if n == 3 else ''}</body>") for n in range(20)]
    two = [(100 + n, "http://two/x", f"<body>{top.format(n=n)}" + (f"<article><p>text {n}</p></article>" if n % 2 else f"<div class=wrap><article><p>text {n}</p></article></div>") + "</body>") for n in range(20)]
    links = f"<div class=top>{'<a href=1>link</a> ' * 9}</div>"
    plain = [(200 + n, "http://plain/x", f"<body>{links}" + (f"<div class=k><p>words here {n}</p></div>" if n % 2 else f"<div class=w><div class=v><p>words here {n}</p></div></div>") + "</body>") for n in range(20)]
    got = {r.page_id: r.main_text for r in html_template.main_text(spark.createDataFrame(odd + two + plain, "page_id int, url string, html string"), Stages(spark)).collect()}
    assert got == {**{n: f"text {n}" + ("\ntwo" if n == 3 else "") for n in range(20)}, **{100 + n: f"text {n}" for n in range(20)},
                   **{200 + n: f"words here {n}" for n in range(20)}}


def test_pages_awkward(spark):
    rows = [(1, "http://a/1", None, "mine"), (None, None, "", "mine"), (2, "no url", "plain <b>text</b> a < b", "mine"), (3, "http://a/1", "<article>cut <p>off <a href='x", "mine"),
            (3, "http://a/1", "<article>cut <p>off <a href='x", "mine"), (4, "http://c/", "<article>" + "<p>long</p>" * 20_000, "mine"), (5, "http://c/", "<script>never closed", "mine")]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, main_text string").withColumns({n: F.lit(0) for n in ("host", "slot", "path")})
    got = html_template.main_text(pages, Stages(spark)).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.main_text for r in got}
    assert text == {1: "", None: "", 2: "plain text a < b", 3: "cut\noff", 4: "\n".join(["long"] * 20_000), 5: ""}
    assert html_template.main_text(pages.limit(0), Stages(spark)).count() == 0


def test_pages_of_the_table(spark, sf_dir):
    """On the given pages: exactly the article's blocks."""
    import html
    import re

    got = html_template.main_text(table(spark, sf_dir, "pages"), Stages(spark)).collect()
    for r in got:
        article = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?p>|</?h1>", article))
        assert r.main_text == "\n".join(b for b in blocks if b)


def brute(vectors, labels, cosine=0.93):
    n = len(vectors)
    links, root = [[] for _ in range(n)], list(range(n))
    for i in range(n):
        for j in range(n):
            a, b = vectors[i], vectors[j]
            if i != j and labels[i] is not None and labels[i] == labels[j] and a is not None and b is not None and len(a) == len(b):
                a, b = np.array(a, float), np.array(b, float)
                if np.isfinite(a).all() and np.isfinite(b).all() and a.any() and b.any() and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                    links[i].append(j)
    for _ in range(n):
        for i in range(n):
            for j in links[i]:
                root[i] = root[j] = min(root[i], root[j])
    return [len(x) for x in links], root


@pytest.mark.parametrize("cell_rows", [8192, 20])
def test_links_equal_brute_force(spark, cell_rows):
    rng = np.random.default_rng(1)
    vectors, labels = [], []
    for c in range(6):
        centre = rng.normal(size=16)
        for k in range(30):
            vectors.append([float(x) for x in np.float32(centre + rng.normal(size=16) * (0.02, 0.25, 0.4)[k % 3])])
            labels.append(c % 3)
    vectors += [vectors[0], vectors[0], [x * 2 for x in vectors[0]]]
    labels += [labels[0], labels[0], labels[0]]
    rows = [(n, v, int(label)) for n, (v, label) in enumerate(zip(vectors, labels))]
    got = cover_tree.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"), Stages(spark), cell_rows=cell_rows).toPandas().sort_values("vec_id")
    count, root = brute(vectors, labels)
    assert list(got["n_links"]) == count and list(got["component_id"]) == root
    assert list(got["kept"]) == [n == r for n, r in enumerate(root)]


@pytest.mark.parametrize("spread, size", [(0.1, 64), (0.3, 64), (1.0, 8), (0.02, 3)])
def test_traversal_of_large_labels(monkeypatch, spread, size):
    """Trees of 1500 points, more than any leaf: every link once, within a tree and between two, at any leaf size."""
    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(30, size)), 50, axis=0) + rng.normal(size=(1500, size)) * spread
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.93
    np.fill_diagonal(near, False)
    for leaf in (cover_tree.LEAF, 1, 1 << 14, 1 << 20):
        monkeypatch.setattr(cover_tree, "LEAF", leaf)
        links = cover_tree.Links(np.ones(len(x), np.int64))
        cover_tree.traverse(cover_tree.CoverTree(x), None, 0.93, links, 0)
        assert (links.count == near.sum(axis=1)).all()
        roots = np.array([links.find(i) for i in range(len(x))])
        assert all(roots[i] == roots[j] for i, j in zip(*np.nonzero(near)))
        half = cover_tree.Links(np.ones(len(x), np.int64))
        cover_tree.traverse(cover_tree.CoverTree(x[:700]), cover_tree.CoverTree(x[700:]), 0.93, half, 700)
        assert (half.count == np.r_[near[:700, 700:].sum(axis=1), near[:700, 700:].sum(axis=0)]).all()


def test_vectors_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], None), (2, None, 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, 0.1], 1),
            (8, [1.0, 0.0, 0.0], 1), (9, [], 1), (7, [1.0, 0.1], 1), (10, [1.0, 0.0], 2)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumns({n: F.lit("mine") for n in ("h", "cell", "copies", "root", "first")})
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in cover_tree.near_vectors(frame, Stages(spark)).collect())
    alone = [(n, 0, n, True) for n in (1, 2, 3, 4, 5, 6, 8, 9, 10)]
    assert got == sorted([(0, 2, 0, True), (7, 2, 0, False), (7, 2, 0, False), *alone])
    assert cover_tree.near_vectors(frame.limit(0), Stages(spark)).count() == 0
