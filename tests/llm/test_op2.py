import pytest

from tidemark.llm import op2_html as X

CASES = {
    "<html><body><nav><a>Home</a></nav><article><h1>T &amp; U</h1><p>one<b>two</b> th&eacute;<br>x<p>next<script>var a='</p>'</script></article><footer>f</footer>": "T & U onetwo thé x next",
    "<p>plain <p>two": "plain two",
    "a < b &lt; c <3": "a < b < c <3",
    "<article>a<div class='ad'>buy</div><div class=\"post-share\">s</div><aside>q</aside><form>f<p>g</form>b<!-- c --></article><div>out</div>": "a b",
    "<article>text<section id=comments><article class=comment>first!</article></section></article>": "text",
    "<body class='has-sidebar'><header>H</header><main><header><h1>Title</h1></header>body</main><div role=alert>x</div></body>": "Title body",
    "<div hidden>no</div><div class=\"Cookie-Notice\">no</div><ul class=mainMenu><li>no</ul><p>yes": "yes",
    "<article><ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table></article>": "a b 1 2 3",
    "<article><p title='a > b'>x</p><p title=\"un'x\">y</p></article>": "x y",
    "<article>cut off <a href='x": "cut off",
    "<article><p>a&nbsp;b &#x41;&#66; &am</article>": "a b AB &am",
    "": "", "   ": "", "<nav>only</nav>": "", "<!-- never closed": "", "<![CDATA[x]]>y": "y", "<script>x": "",
    "<TITLE>t</TITLE><STYLE>p{}</style><ARTICLE>Loud<BR/>er</ARTICLE>": "Loud er",
    "<article><p>a<i>b<p>c</i>d</article>e": "ab cd",
}


@pytest.mark.parametrize("html", CASES)
def test_main_text(html):
    assert X.main_text(X.parse(html)) == CASES[html]


def test_deep_and_broken_pages_end():
    deep = "<div>" * 50_000 + "x"
    assert X.main_text(X.parse(deep)) == "x"
    assert X.main_text(X.parse("<p a='" * 20_000)) == ""
    assert X.main_text(X.parse("<" * 50_000)) == "<" * 50_000
    assert X.main_text(X.parse("<article>" + "word &amp; " * 200_000 + "</article>")) == " ".join(["word &"] * 200_000)


def test_style_tree_removes_what_all_pages_of_a_host_share(spark):
    same = "<div class='box'><p>Welcome to our site</p><span>Call us</span></div>"
    rows = [(i, f"http://a.org/{i}", f"<body>{same}<div class='story'><p>Story {i} begins</p><p>and {i * i} ends</p></div></body>") for i in range(12)]
    rows += [(100 + i, f"http://b.org/{i}", f"<body>{same}<p>only two pages {i}</p></body>") for i in range(2)]
    rows += [(200 + i, f"http://c.org/{i}", f"<body>{same}</body>") for i in range(6)]
    rows += [(300, None, None), (301, "x", ""), (None, "http://a.org/q", rows[0][2]), (0, *rows[0][1:])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, n_chars int").repartition(3)
    got = [(r.page_id, r.text, r.n_chars) for r in X.extract(df).collect()]
    assert len(got) == len(rows) and all(len(t) == n for _, t, n in got)
    by = dict((p, t) for p, t, _ in got if p is not None)
    for i in range(12):
        assert by[i] == f"Story {i} begins and {i * i} ends"
    assert by[100] == "Welcome to our site Call us only two pages 0"
    assert by[200] == "Welcome to our site Call us"  # nothing else is on it
    assert by[300] == by[301] == ""


def test_joined_paths_equal_broadcast_ones(spark, monkeypatch):
    rows = [(i, "http://a.org/", f"<div class=q>same</div><p>text {i}</p>") for i in range(8)] + [(9, "http://z.org", "<p>x</p>"), (10, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted(X.extract(df).collect())
    monkeypatch.setattr(X, "BROADCAST_ROWS", -1)
    assert sorted(X.extract(df).collect()) == want and want[0].text == "text 0"


def test_empty(spark):
    out = X.extract(spark.createDataFrame([], "page_id long, url string, html string"))
    assert out.count() == 0 and out.columns == ["page_id", "url", "text", "n_chars"]


@pytest.mark.parametrize("depth", [300, 30_000])
def test_text_after_and_in_a_closed_deep_nest(depth):
    """Surplus end tags would close the article; a menu or form below any depth is one."""
    nest = "<div>" * depth + "deep<nav>menu<p>more</nav><form>f</form>" + "</div>" * depth
    runs = X.parse(f"<div id=page><article>{nest}<p>after</p></article></div><p>out</p>")
    assert X.main_text(runs) == X.main_text(runs, {0}) == "deep after"
    X.style_features(runs)


def test_stray_end_tags_in_a_deep_nest_cost_no_search():
    page = "<b><div>" + "<i>" * 30_000 + "x" + "</b></u></section>" * 30_000
    assert X.main_text(X.parse(page)) == "x"
    low = {n.path for n, _ in X.parse("<div class=q><p>x") if n is not None and n.tag == "div"} | {0}
    assert X.main_text(X.parse("<div>" * 30_000 + "y"), low) == "y"


WORDS = {
    "<body><div class='layout no-sidebar'><p>all</p></div></body>": "all",
    "<div class='page--has-sidebar'><main><p>m</p></main></div>": "m",
    "<div class='withBanner'><article>a</article></div>": "a",
    "<div class='sidebar-layout'><nav>n</nav><div class=widget><article>real</article></div><div class=widget>w</div></div>": "real",
    "<main><h1>t</h1><div class='promo-page'><article>real</article></div></main>": "t real",
    "<article><h2 id='share-prices'>Shares</h2><p id='search'>s</p><section id='related-work'>r</section><div id='notice-of-1912'>n</div></article>": "Shares s r n",
    "<article>a<div id='sidebar-left'>x</div><div id=comments>x</div><div class='no-js share'>x</div></article>": "a",
    "<article>a<div class=comments><article>first!</article></div></article>": "a",
    "<div class=related><nav><article>teaser</article></nav>x</div><p>b": "b",
    "<div class='layout sidebar-right'><p>everything</p><nav>n</nav></div>": "everything",
    "<nav class=menu>only</nav>": "", "<header>only</header>": "",
}


@pytest.mark.parametrize("html", WORDS)
def test_words_are_evidence_not_a_verdict(html):
    assert X.main_text(X.parse(html)) == WORDS[html]
