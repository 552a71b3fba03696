"""Main text of pages: trees, alignment, blocks, wrappers."""

import pytest

from wattline.llm import dom
from wattline.llm import wrapper as W


def text(page):
    return W.text_of(page, None, set())


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("plain  text", "plain text"),
        ("<article><h1>T &amp; x</h1><p><b>one<br><p>two\n three</p></article><footer>&copy; z</footer>", "T & x\n\none\n\ntwo three"),
        ("<nav><a>menu</a></nav><article><p>a<script>var t='</p>';</script><!-- <p>no</p> -->b</article>", "ab"),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>cut</p><p cla", "cut"),
        ("<article><p>1 < 2 &lt;b&gt; a&nbsp;b</p><div class='ad-box'>buy</div><form>x</form><aside>y</aside></article>", "1 < 2 <b> a b"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><section class=comments><p>me too</p></section></article>", "a\n\nb\n\nc\n\nd"),
        ("<header>top</header><main><p>x <i>y</i>z</p></main><div id='cookie-notice'>ok?</div>", "x yz"),
        ("<article class='comment'>no</article><article><header><h1>H</h1></header>body</article>", "H\n\nbody"),
        ("<article><p>a</p><style>p{}</style><p hidden>h</p></div></span><p>b</article>", "a\n\nb"),
        ("<p>a<p>b<div>c</div>d", "a\n\nb\n\nc\n\nd"),
    ],
)
def test_text(page, want):
    assert text(page) == want


def test_alignment_keeps_order_and_finds_the_most():
    a = dom.shape([dom.parse("<div><p>1</p><ul><li>x</li></ul><table><tr><td>q</table></div>")])
    b = dom.shape([dom.parse("<div><span>new</span><p>2</p><p>3</p><table><tr><td>r</table><ul><li>y</li></ul></div>")])
    keys = [x.key[0] for x, y in dom.match(a, b)]
    assert keys == ["html", "div", "p", "table", "tr", "td"]
    assert all(x.key == y.key for x, y in dom.match(a, b))
    assert dom.match(a, dom.shape([dom.Node("body")])) == []


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id bigint, url string, html string, text string")


def page(i, note="Call us now"):
    return f"<html><body><div class=x1><p>{note}</p></div><div class=x2><p>story {i}</p><p>more {i * 7}</p></div><div class=x3>All rights</div></body></html>"


def test_constant_nodes_of_a_host_are_template(spark):
    rows = [(i, f"http://A.example/p/{i}", page(i)) for i in range(40)]
    rows += [(100 + i, "http://a.example:80/copy", page(5)) for i in range(200)]
    rows += [(400 + i, f"https://b.example/{i}", page(400 + i, f"note {i}")) for i in range(20)]
    rows += [(500, "http://lone.example/", page(500)), (501, None, page(501))]
    got = {r.page_id: r.text for r in W.main_text(pages(spark, rows)).collect()}
    assert got[3] == "story 3\n\nmore 21" and got[150] == "story 5\n\nmore 35"
    assert got[405] == "note 5\n\nstory 405\n\nmore 2835"
    assert got[500] == "Call us now\n\nstory 500\n\nmore 3500\n\nAll rights"
    assert got[501].startswith("Call us now")


@pytest.mark.parametrize("near", [False, True])
def test_a_family_of_copies_makes_no_template(spark, near):
    story = "<div class=x2><p>the one story that is told again and again</p><p>and its end</p></div>"
    copy = lambda i: f"<html><body><div class=x1><p>Call us now</p></div>{story}<div class=x3>seen {i if near else i % 2}</div></body></html>"
    other = lambda i: copy(i).replace(story, f"<div class=x2><p>story {i} of some other kind</p><p>{'more ' * 4000}</p></div>")
    rows = [(i, f"http://a/{i}", copy(i)) for i in range(1200)] + [(2000 + i, f"http://a/{i}", other(i)) for i in range(8)]
    parts = pages(spark, rows).repartition(100, "page_id")
    got = {r.page_id: r.text for r in W.main_text(parts).collect()}
    assert all("the one story" in got[i] and "its end" in got[i] for i in range(1200))
    assert all("story" in got[2000 + i] and "Call us now" not in got[2000 + i] for i in range(8))


def test_the_wrapper_decides_on_pages_with_articles(spark):
    html = "<body><main><h1>Title {0}</h1><div class=lead>lead {0}</div><article><p class=note>Our rules apply</p><div><p>story {0}</p><p>more {1}</p></div></article></main><div class=x>All rights</div><nav>go {0}</nav></body>"
    rows = [(i, f"http://a/{i}", html.format(i, i * 7)) for i in range(30)]
    rows += [(100 + i, f"http://b/{i}", f"<body><article><p>always the same</p></article><div class=x>seen {i}</div></body>") for i in range(30)]
    rows += [(200, "http://lone/", html.format(1, 7)), (201, "http://a/other", "<main><p>lead</p><article><p>x</p></article></main>")]
    got = {r.page_id: r.text for r in W.main_text(pages(spark, rows)).collect()}
    assert got[3] == "Title 3\n\nlead 3\n\nstory 3\n\nmore 21"
    assert got[104] == "always the same\n\nseen 4"
    assert got[200] == "Our rules apply\n\nstory 1\n\nmore 7"
    assert got[201] == "lead\n\nx"


def test_edges(spark):
    rows = [(1, "http://a/x", None), (1, "http://a/x", None), (None, None, ""), (2, "no url", "<p>" * 2000 + "deep"), (3, "http://a/y", "<div>" * 4000 + "z" + "w " * 50_000)]
    got = W.main_text(pages(spark, rows))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted((r.page_id or 0, r.text[:8], r.n_chars) for r in got.collect())
    assert found == [(0, "", 0), (1, "", 0), (1, "", 0), (2, "deep", 4), (3, "zw w w w", 100_000)]
    assert W.main_text(pages(spark, [])).collect() == []
