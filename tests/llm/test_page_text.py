"""Main text of planted pages, and tree matching against its plain recursion."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from tallgrass.llm import page_text
from tallgrass.llm.page_text import main_blocks, parse
from tests.conftest import SF_DIR
from tests.llm.test_text_operators import prose


def text_of(source):
    return "\n\n".join(main_blocks(parse(source), set()))


def expected(source):
    """Pages of the given table: one article of headings and paragraphs."""
    body = re.search(r"<article>(.*?)(</article>|$)", source, re.DOTALL)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(b for b in blocks if b)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    got = {r.page_id: r for r in page_text.page_texts(spark, pages).collect()}
    given = pages.collect()
    assert len(got) == len(given)
    for r in given:
        assert (got[r.page_id].url, got[r.page_id].text, got[r.page_id].n_chars) == (r.url, expected(r.html), len(expected(r.html)))


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("", ""),
        ("just text", "just text"),
        ("<p>a<p>b &amp; c &lt;d&gt; &#233;&nbsp;x &amp y &unknown;", "a\n\nb & c <d> é x & y &unknown;"),
        ("<article>one <b>bold</b>\n\t text<br>next<ul><li>i<li>j</ul>tail", "one bold text next\n\ni\n\nj\n\ntail"),
        ("<article><header><div>by me</div><h1>T</h1></header><p>x</p><footer>f</footer></article><p>out</p>", "T\n\nx"),
        ("<header><h1>Site</h1></header><main><p>m</p><aside>s</aside><form><input>q</form></main>", "m"),
        ("<article><p>short</p></article><article><p>the long one</p></article>", "the long one"),
        ("<article>A text<section class='comments'><article>a much longer comment than that</article></section></article>", "A text"),
        ("<form id=f><div class=wrap><article><p>in a form</p></article></div></form>", "in a form"),
        ("<div class='has-sidebar'><p>kept</p></div><div class='sideBar'>gone</div><div id=cookie-consent>gone</div>", "kept\n\ngone"),
        ("<div class='side-bar siteSidebar'><p>no</p></div><p>yes", "yes"),
        ("<article>a<script>var t='</p>';x<y</script><style>p{}</style><!-- c --><!-->b<noscript>n</noscript>c</article>", "abc"),
        ("<article><p title='a>b' x=\">\">q</p><span hidden>h</span><span class=ad>ad</span> r</article>", "q\n\nr"),
        ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n\n2\n\n3"),
        ("<article><p>cut off <a href='x", "cut off"),
        ("<article><p>a</div></span></p>b</article>", "a\n\nb"),
        ("<article><p>1 < 2 & 3 <4</p></article>", "1 < 2 & 3 <4"),
        ("<body><div><a href=x>only a link</a></div><p>some text with <a>a link</a> in it</p></body>", "some text with a link in it"),
        ("<h1>Title</h1><div><p>" + "word " * 40 + "</p><p>more</p></div><div>x</div>", "Title\n\n" + ("word " * 40).strip() + "\n\nmore"),
        ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"),
        ("<p" * 3000, ""),
        ("<a b='" * 2000, ""),
    ],
)
def test_markup(source, want):
    assert text_of(source) == want


def test_very_long_page():
    blocks = [prose(i, 40) for i in range(4000)]
    source = "<nav>" + "<a>x</a>" * 1000 + "</nav><article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"
    assert text_of(source) == "\n\n".join(" ".join(b.split()) for b in blocks)


def site(i, marked):
    """A page without names that tell its parts: banner and tail are the same everywhere, in the article as well."""
    own = [prose(1000 * i + k, 30) for k in range(1 + i % 4)]
    inner = f"<h2>{prose(i, 5)}</h2>" + "".join(f"<p>{b}</p>" for b in own) + "<p>Read more on our start page today</p>"
    inner = f"<article>{inner}</article>" if marked else f"<div class=x{i}>{inner}</div>"
    extra = "<table><tr><td>Weather fine</table>" if i % 3 else ""
    source = f"<body><div><p>We like biscuits, press yes to go on</p></div>{extra}{inner}<div><p>All rights are ours and yours</p></div></body>"
    return source, "\n\n".join([prose(i, 5), *[" ".join(b.split()) for b in own]])


@pytest.mark.parametrize("marked", [True, False])
def test_template_of_a_host(spark, monkeypatch, marked):
    monkeypatch.setattr(page_text, "TREES", 2)
    rows, want = [], []
    for i in range(24):
        source, text = site(i, marked)
        rows.append((i, f"http://me@a.example:80/{i}", source))
        want.append((i, text))
    copied = f"<body><article><h1>News</h1><p>{prose(77, 60)}</p></article></body>"  # many copies are no template
    near = [copied.replace("News", f"News {k}") for k in range(40)]
    rows += [(100 + k, "https://A.example/copy", s) for k, s in enumerate(near)]
    want += [(100 + k, f"News {k}\n\n" + " ".join(prose(77, 60).split())) for k in range(40)]
    rows += [(200, None, "<p>alone"), (201, "no host", None), (None, "http://b.example/", ""), (None, "http://b.example/", "<p>x"), (0, rows[0][1], rows[0][2])]
    want += [(200, "alone"), (201, ""), (None, ""), (None, "x"), (0, want[0][1])]
    pages = spark.createDataFrame([(*r, 1, "t", 2, "n") for r in rows], "page_id long, url string, html string, name int, text string, host int, tree string").repartition(3)
    got = page_text.page_texts(spark, pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted(((r.page_id, r.text) for r in got.collect()), key=str)
    assert found == sorted(want, key=str)
    assert {(r.url, r.n_chars == len(r.text)) for r in got.collect()} == {(r[1], True) for r in rows}
    assert page_text.page_texts(spark, pages.limit(0)).count() == 0
    assert page_text.page_texts(spark, pages.where(F.col("html").isNull())).count() == 1


def plain_match(a, b):
    """Simple tree matching by its table of children against children."""
    if a.label != b.label:
        return 0
    table = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children, 1):
        for j, y in enumerate(b.children, 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + plain_match(x, y))
    return table[-1][-1] + 1


def random_tree(rnd, depth=0):
    node = page_text.Node("root" if depth == 0 else rnd.choice("abcd"), 1, 0)
    if depth < 3:
        node.children = [random_tree(rnd, depth + 1) for _ in range(rnd.randint(0, 5))]
    return node


def test_matching_is_the_best_one():
    rnd = random.Random(8)
    for _ in range(300):
        a, b = random_tree(rnd), random_tree(rnd)
        size, pairs = page_text.match(a, b)
        assert size == plain_match(a, b) == 1 + sum(plain_match(x, y) for x, y in pairs)
        places = [([id(c) for c in a.children].index(id(x)), [id(c) for c in b.children].index(id(y))) for x, y in pairs]
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(places, places[1:], strict=False))


def test_merged_trees_hold_both_and_read_back():
    rnd = random.Random(9)
    for _ in range(100):
        a, b = random_tree(rnd), random_tree(rnd)
        whole = plain_match(b, b)
        page_text.merge(a, page_text.read_tree(page_text.write_tree(b)))
        assert plain_match(a, b) == whole and a.pages == 2
        assert page_text.write_tree(page_text.read_tree(page_text.write_tree(a))) == page_text.write_tree(a)


def test_large_wrappers_lose_rare_nodes_only(monkeypatch):
    monkeypatch.setattr(page_text, "NODES", 50)
    wrapper = page_text.read_tree("-1 html\n0 nav\n0 p", 400)
    for i in range(200):
        page_text.merge(wrapper, page_text.read_tree(f"-1 html\n0 nav\n0 x{i}\n0 p", 1))
        page_text.prune(wrapper)
    kept = {c.label: c.pages for c in wrapper.children}
    assert kept["nav"] == kept["p"] == 600 and len(kept) <= 52


def test_large_wrappers_keep_the_template_of_rare_nodes(spark):
    """Six of 700 pages hold a banner of their own; the host's wrapper is too large to keep its node."""
    rows, want = [], []
    for i in range(700):
        parts = [prose(100 * i + k, 12) for k in range(40)]
        names = ["z" + "".join(chr(107 + int(d)) for d in f"{i}") + "-" + "y" * k for k in range(40)]  # names without digits are labels
        inner = "".join(f"<div class={name}>{p}</div>" for name, p in zip(names, parts, strict=True))
        banner = "<section class=rare><p>This week the shop is open on Sunday too</p></section>" if i % 117 == 0 else ""
        rows.append((i, f"http://large.example/{i}", f"<body><article>{inner}{banner}</article></body>"))
        want.append((i, "\n\n".join(" ".join(p.split()) for p in parts)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = sorted((r.page_id, r.text) for r in page_text.page_texts(spark, pages).collect())
    assert found == want
