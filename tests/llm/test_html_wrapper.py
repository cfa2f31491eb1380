import pytest

from placeforge.llm import html_wrapper
from tests.llm.tables import CLASH_SCHEMA, CLASHING


def pages(spark, rows):
    schema = CLASH_SCHEMA.replace("host string", "hosts string")
    return spark.createDataFrame([(*r, *CLASHING.values()) for r in rows], f"page_id long, url string, html string, {schema}")


def rich(i):
    return f"""<!doctype html><html><head><title>T{i}</title></head><body class="home has-sidebar comments-open"><header class="site"><h2>My Site</h2></header>
<div id="cookie-banner">We use cookies</div><div class="breadcrumb"><a href="/">Home</a> &gt; <a>News</a></div>
<div class="content-sidebar-wrap no-comments"><div class="sidebar"><ul><li><a>x{i}</a><li><a>y</a></ul></div><main><article id="post-{i}">
<header><h1>Head line&nbsp;{i}</h1></header><p>First <b>bold{i}</b> text<br>next   line. &lt;tag&gt; &#8364;5<div class="ad-slot">BUY{i}</div>
<h2>Sub{i}</h2><ul><li>one{i}<li>two</ul><table><tr><td>a{i}<td>b</table><aside>aside{i}</aside>
<form><input name=q><button>Go</button>Search</form><section class="comments"><h3>Comments</h3><div class="comment">nice {i}</div></section>
<div class="share-buttons"><a>Share</a></div><footer>Tags{i}</footer></article></main></div><footer>&copy; 2020</footer>
<script>if(a<b){{x="</p>"}}</script></body></html>"""


def bare(i):
    return (
        f'<body><div class="top"><a href=1>A</a> <a>B</a></div><div class="c1"><h1>T{i}</h1><p>para {i} text</p>{"<p>more</p>" * i}'
        f'<p>end {i}</p></div><div class="bottom">All rights reserved</div><div id="comments"><p>c{i}</p></div>'
    )


def test_text_of_pages(spark):
    rows = [(i, f"https://rich.example/{i}", rich(i)) for i in range(6)]
    rows += [(100 + i, f"http://Bare.example:80/{i}?q=1", bare(i)) for i in range(5)]
    rows += [
        (200, "http://a.example/", None), (201, None, "just text"), (202, "http://b.example", "<p>a<p>b<"), (203, "http://c.example", ""),
        (None, "http://d.example", "<div>x<p>y</div>z 5 < 6 and 7 > 3"), (204, "http://e.example", "<p>" + "long " * 60_000),
        (205, "http://f.example", "<b><i>" * 3000 + "<div>" * 3000 + "deep"), (1, "https://rich.example/1", rich(1)),
    ]
    found = [(r.page_id, r.text, r.n_chars) for r in html_wrapper.extract(pages(spark, rows).repartition(4)).collect()]
    text = {k: t for k, t, _ in found}
    assert len(found) == len(rows) and all(len(t) == n for _, t, n in found)
    assert text[3] == "Head line 3\nFirst bold3 text next line. <tag> €5\nSub3\none3\ntwo\na3\nb"
    assert text[102] == "T2\npara 2 text\nmore\nmore\nend 2"
    assert [text[k] for k in (200, 201, 202, 203, None, 205)] == ["", "just text", "a\nb<", "", "x\ny\nz 5 < 6 and 7 > 3", "deep"]
    assert text[204] == " ".join(["long"] * 60_000)
    assert [t for k, t, _ in found if k == 1] == [text[1]] * 2


def test_no_pages(spark):
    assert html_wrapper.extract(pages(spark, [])).count() == 0


def expression(html):
    return html_wrapper.fold(html_wrapper.read_page(html)[0][1])


@pytest.mark.parametrize("order", [1, -1])
def test_mismatches_become_optional_or_repeated(order):
    a = expression("<h1>t</h1><p>x</p><div><h2>s</h2><p>y</p><h2>s</h2><p>y</p></div>")
    b = expression("<h1>t</h1><p>x</p><p>z</p><table><tr><td>v</td></tr></table><div><h2>s</h2><p>y</p></div>")
    wrapper = html_wrapper.align(*[a, b][::order])
    assert [e[:2] for e in wrapper] == [["h1", "1"], ["p", "+"], ["table", "?"], ["div", "1"]]
    assert {tuple(e[:2]) for e in wrapper[3][2]} >= {("()", "*")} or wrapper[3][2][0][:2] == ["()", "+"]
    assert set(html_wrapper.slots_of(wrapper)) == {"h1", "p", "table/tr/td", "div/h2", "div/p"}


def test_wrappers_do_not_depend_on_salting(spark, monkeypatch):
    rows = pages(spark, [(i, "http://x.example", bare(i % 4) if i % 2 else rich(i)) for i in range(30)]).selectExpr("'x' AS host", "html")
    slots = []
    for salts in (1, 16):
        monkeypatch.setattr(html_wrapper, "SALTS", salts)
        found = html_wrapper.decided(html_wrapper.infer_wrappers(html_wrapper.structures(rows))).first()
        slots.append(dict(zip(found.paths, found.regions, strict=True)))
    assert slots[0] == slots[1] and found.pages == 30


def test_large_hosts_are_folded_level_by_level(spark, monkeypatch):
    assert html_wrapper.levels(0) == html_wrapper.levels(4096) == [16] and html_wrapper.levels(256**3) == [256**2, 256, 16]
    kinds = [f"<div class=c{chr(97 + i % 26)}{chr(97 + i // 26)}><p>x{i}</p></div><article><p>y</p></article>" for i in range(60)]
    rows = spark.createDataFrame([("x", k) for k in kinds], "host string, html string")
    found = html_wrapper.structures(rows)
    whole = html_wrapper.infer_wrappers(found).first()
    monkeypatch.setattr(html_wrapper, "GROUP", 4)
    monkeypatch.setattr(html_wrapper, "SALTS", 2)
    assert html_wrapper.levels(60) == [15, 4, 2]
    by_level = html_wrapper.infer_wrappers(found).first()
    slots = [sorted(html_wrapper.slots_of(html_wrapper.json.loads(w.expression))) for w in (whole, by_level)]
    assert slots[0] == slots[1] and len(slots[0]) == 61


def test_copies_of_a_page_are_no_template(spark):
    """A page whose layout no other page of its host has keeps its text however often it is repeated."""
    own = '<body><div class="special"><h1>Own head</h1><p>Own text of this page alone</p></div>'
    rows = [(i, "http://x.example/own", own) for i in range(8)] + [(100 + i, f"http://x.example/{i}", bare(i)) for i in range(5)]
    text = {r.page_id: r.text for r in html_wrapper.extract(pages(spark, rows).repartition(4)).collect()}
    assert {text[i] for i in range(8)} == {"Own head\nOwn text of this page alone"}
    assert text[102] == "T2\npara 2 text\nmore\nmore\nend 2"


def test_cards_do_not_hide_the_body(spark):
    """Small <article> cards beside a body of another region; a heading and a lead of the main part before an article."""
    def cards(i):
        card = f'<article><h3>Card {i}</h3><p>see this {i}</p></article><article><h3>Card {i + 1}</h3><p>or that</p></article>'
        return f'<body><div class="post-body"><h1>Body {i}</h1><p>{"long text of page %d " % i * 20}</p></div><div class="more-posts">{card}</div></body>'

    def linked(i):
        card = f'<article><a href="/{i}">A very long title of another page, number {i}, all of it in a link</a></article>'
        return f'<body><div class="post-body"><h1>Body {i}</h1><p>short {i}</p></div><div class="more-posts">{card * 3}</div></body>'

    def lead(i):
        return f'<body><main><h1>Head {i}</h1><div class="share">Share</div><p>Lead {i}</p><article><p>article text of page {i}</p></article><p>after {i}</p></main></body>'

    rows = [(100 * k + i, f"http://{kind.__name__}.example/{i}", kind(i)) for k, kind in enumerate((cards, linked, lead)) for i in range(5)]
    rows += [(900, "http://roundup.example", '<body><p>tag</p><article><p>See <a href="/">a link with a long title</a> here</p></article></body>'), (901, "http://links.example", "<article><a>a link</a></article>")]
    text = {r.page_id: r.text for r in html_wrapper.extract(pages(spark, rows).repartition(4)).collect()}
    assert text[3] == "Body 3\n" + " ".join(["long text of page 3"] * 20)
    assert text[103] == "Body 3\nshort 3"
    assert text[203] == "Head 3\nLead 3\narticle text of page 3"
    assert text[901] == "a link" and text[900] == "See a link with a long title here"
