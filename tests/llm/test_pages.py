"""URL rules and page text."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import extract, urlrules

URLS = [
    "http://www.Example.com/en/x?q#f", "https://example.com/en/", "http://a.b.example.com/en/1", "http://example.com", "http://com/",
    "http://xcom/", "http://a.net/es/1", "ftp://net/fr/", "http://a.net/esx", None, "", "no scheme", "http:///only/path", "http://a..com/x",
    "http://com./", "http://h\u00c9.com/?x", "x://y://z/", "http://user@a.com:80/p", "://net/es/", "http://www.example.com/EN/", "http://" + "a." * 3000 + "com/",
]
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def judged_by_hand(url, rules, default="allow"):
    import re

    url = url or ""
    if "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    rules = [(h, p or "", v) for h, p, v in rules if h]
    fit = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else default


@pytest.mark.parametrize("rules", [RULES, [], RULES + [("com", "/", "block"), (None, "/", "block"), ("", "/", "block"), ("com", None, "block")]])
def test_rules_by_hand(spark, rules):
    pages = spark.createDataFrame([(i, u, "c") for i, u in enumerate(URLS * 2)] + [(None, URLS[0], "c")], "page_id bigint, url string, host string")
    given = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urlrules.judge(pages, given).collect()}
    assert got == {(i, *judged_by_hand(u, rules)) for i, u in [*enumerate(URLS * 2), (None, URLS[0])]}


def test_many_nested_rules_and_a_hot_host(spark):
    random.seed(5)
    labels = ["a", "b", "ab", "c"]

    def host():
        return ".".join(random.choice(labels) for _ in range(random.randint(1, 5)))

    def path():
        return "/" + "/".join(random.choice(["x", "xy", "z"]) for _ in range(random.randint(0, 3)))

    rules = sorted({(host(), path() if random.random() < 0.7 else "", "block" if random.random() < 0.5 else "allow") for _ in range(300)})
    urls = [f"http://{host()}{path()}" for _ in range(1500)] + ["http://a.b.c/x"] * 700
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlrules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert got == {i: judged_by_hand(u, rules) for i, u in enumerate(urls)}
    assert urlrules.judge(pages.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t="</p><article>";</script></head>
<body class="page menu-open"><header><h2>Site</h2></header><nav><ul><li>Home</nav><div class="cookie-notice"><p>We use cookies</div>
<div id=sidebar><ul><li>Old</li></ul></div><article class="post"><header><h1>Big&nbsp;&lt;b&gt;  title</h1><p>by me</p></header>
<p>One <b>bold</b>word &eacute;<br>line<p>Two<!-- not this --></p><ul><li>item 1<li>item 2</ul><div class="ad"><p>Buy</p></div><form><p>mail</p></form>
<p>5 < 6 &amp;lt; 7</p><section class="comments"><article><p>First!</p></article></section></article><aside><p>more</p></aside><footer>&copy;</footer>"""


def test_article_of_a_page():
    lines = extract.page_lines(PAGE)
    assert [text for text, _ in lines] == ["Big <b> title", "One boldword \u00e9 line", "Two", "item 1", "item 2", "5 < 6 &lt; 7"]
    assert all(inside for _, inside in lines)


def test_names_of_elements():
    def texts(page):
        return [text for text, _ in extract.page_lines(page)]

    assert texts('<main class="has-sidebar no-ads"><div class="entry-header"><h1>T</h1><p>by</p></div><p>a</p></main><p>out') == ["T", "a"]
    assert texts('<div class="site-header"><h1>Site</h1></div><div class="with-nav"><p>a</p><div role=navigation>n</div></div>') == ["a"]
    assert texts('<article><p>a</p><article class="comment"><p>c</p></article><p hidden>h</p><p>b</p></article>') == ["a", "b"]
    assert texts('<body class="ad-free"><p>adrift</p><p class="lead">x<span class="ad">y</span>z</p>') == ["adrift", "xz"]


@pytest.mark.parametrize("page", ["", "plain", "<", "<p", "<p>a", "</p>", "<!-- x", "<script>x", "a</b></i>b", "<b><p>x</b>y", "<a href='>'>q</a>", "&", "\x00"])
def test_broken_markup(page):
    assert all(text for text, _ in extract.page_lines(page))


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above = row[:]
        for j, y in enumerate(b):
            row[j + 1] = above[j] + 1 if x == y else max(above[j + 1], row[j])
    return row[-1]


def test_shared_lines_are_a_longest_common_subsequence():
    random.seed(2)
    for _ in range(400):
        a = [random.choice("abcdef") for _ in range(random.randint(0, 14))]
        b = [random.choice("abcdeg") for _ in range(random.randint(0, 14))]
        marked = [x for x, m in zip(a, extract.shared_lines(a, b)) if m]
        rest = iter(b)
        assert len(marked) == lcs_length(a, b) and all(x in rest for x in marked)


def page_of(*lines):
    return "<body>" + "".join(f"<p>{x}</p>" for x in lines)


def test_pages_are_compared_with_their_nearest(spark):
    rows = [
        (1, "http://h/a/1", page_of("Top", "own 1", "Bottom"), "c"),
        (2, "http://h/a/2", page_of("Top", "own 2", "Bottom"), "c"),
        (3, "http://h/b/1", page_of("Top B", "own 3", "Bottom"), "c"),
        (4, "http://h/b/1", page_of("Top B", "own 3", "Bottom"), "c"),
        (5, "http://g/a/1", page_of("Top", "own 5"), "c"),
        (6, None, None, "c"), (7, "http://h/a/2/x", "", "c"), (8, "http://z/", "<article><p>same</article>", "c"), (9, "http://z/", "<article><p>same</article>", "c"),
        (None, "http://n/", page_of("x"), "c"), (10, "http://long/", page_of(*(f"line {i}" for i in range(20_000))), "c"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    for parts in ("1", "4", "13"):
        with_parts = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = {r.page_id: r for r in extract.extract(pages).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", with_parts)
        texts = {i: r.text for i, r in got.items()}
        assert texts[1] == "own 1" and texts[5] == "Top\n\nown 5" and texts[6] == texts[7] == "" and texts[8] == texts[9] == "same"
        # 2 is next to 7 (nearer by path, empty), 3 and 4 are copies of each other
        assert texts[2] == "Top\n\nown 2\n\nBottom" and texts[3] == texts[4] == "Top B\n\nown 3\n\nBottom"
        assert texts[None] == "x" and texts[10].count("\n\n") == 19_999 and len(got) == len(rows)
        assert all(r.n_chars == len(r.text) for r in got.values())
    assert extract.extract(pages.limit(0)).count() == 0


def test_given_pages_by_hand(spark):
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in extract.extract(pages).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert got[row.page_id] == "\n\n".join(b for b in blocks if b)
    assert pages.select(F.count_distinct("page_id")).first()[0] == len(got)


def test_text_outside_teaser_articles_stays():
    story = "A long story that no element of the page marks as the article, sentence after sentence. " * 5
    page = f"<body><p>Shared line</p><div><p>{story}</p></div><article>Teaser one</article><article>Teaser two</article></body>"
    lines = extract.page_lines(page)
    assert [text for text, _ in lines] == ["Shared line", story.strip(), "Teaser one", "Teaser two"]
    other = extract.page_lines("<body><p>Shared line</p><p>Something else</p></body>")
    assert extract.main_lines(lines, other) == [story.strip(), "Teaser one", "Teaser two"]
    whole = extract.page_lines(f"<body><p>Menu</p><article>{story}</article></body>")
    assert whole == [(story.strip(), True)]


@pytest.mark.parametrize("broken", [
    '<svg width="1"/>', '<object data="x"/>', "<button>", "<svg><path d='m'/></svg>", "<video><p>old browser</p></video>",
    "<button>a<button>b</button>", "<p title=don't>", '<p title="x>', "<a title='1 > 0'>", "<a data-x=\"<b>\">",
])
def test_broken_elements_take_no_text_with_them(broken):
    page = f"<html><body><article><p>First one.</p>{broken}<p>Second it's one.</p><p class=\"b\">Third.</p></article></body></html>"
    lines = [line for line, _ in extract.page_lines(page)]
    assert [x for x in lines if x] == ["First one.", "Second it's one.", "Third."], lines


def test_paragraphs_called_after_their_subject_stay():
    paragraphs = "".join(f'<p class="{c}">About {c}.</p>' for c in ("search", "login", "related", "alert"))
    lines = [line for line, _ in extract.page_lines(f"<article>{paragraphs}</article>")]
    assert lines == ["About search.", "About login.", "About related.", "About alert."]
