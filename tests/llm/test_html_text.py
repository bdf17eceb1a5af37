import html
import random
import re
import time

import pytest
from hypothesis import given, settings, strategies as st

from marginfold.llm.html_text import common_subsequence, extract_text, main_text, page_lines

SCHEMA = "page_id long, url string, html string, text string"


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def is_subsequence(a, b):
    b = iter(b)
    return all(x in b for x in a)


@given(st.text(alphabet="abcd", max_size=40), st.text(alphabet="abcd", max_size=40), st.sampled_from([1, 30, 1 << 31]))
@settings(max_examples=500, deadline=None)
def test_common_subsequence_is_longest(a, b, most_bits):
    at = common_subsequence(a, b, most_bits)
    assert at == sorted(set(at)) and len(at) == longest(a, b)
    assert is_subsequence([a[i] for i in at], b)


def text_of(page, other=None):
    lines = page_lines(page)
    return main_text([line for line, _ in lines], [main for _, main in lines], other and [line for line, _ in page_lines(other)])


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header>Site name</header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy</div>
<article><header><h1>Head &amp; line</h1></header><p><b>One</b> two<br>three&nbsp;&eacute;<p>Four <i>fi</i>ve
six</p><aside>Beside</aside><form><label>Mail</label><input></form><div id="comments"><article class="comment">Nice</article></div>
<div class="cookie-notice">Consent</div><p>Last</article><footer>&copy; x</footer>"""


def test_article_without_the_rest():
    assert text_of(PAGE) == "Head & line One two three é Four five six Last"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("plain &lt;text", "plain <text"), ("<p>a<p>b<ul><li>c<li>d", "a b c d"), ("<![if x]>y<![endif]>", "y"),
        ("<div hidden>no</div><div>yes</div></nav></p>", "yes"), ("<head><title>t<body><p>x", "x"), ("a<b", "a<b"), ("&#x41;&#66;&bogus;", "AB&bogus;"),
        ("<main><p>in</p></main><p>out</p>", "in"), ("<script>if (a<b) {}</script>x", "x"),
    ],
)
def test_odd_pages(page, text):
    assert text_of(page) == text


def test_shared_lines_are_deleted_without_an_article():
    frame = "<div>Logo</div><div>Slogan of all pages</div>{}<div>Made by us</div>"
    one, two = frame.format("<p>First text.</p><p>More.</p>"), frame.format("<p>Second text.</p>")
    assert text_of(one, two) == "First text. More."
    assert text_of(two, one) == "Second text."


def test_nearest_pages_of_hosts(spark):
    frame = "<div>{0} logo</div><p>{1}</p><div>{0} end</div>"
    rows = [
        (1, "http://a.example/x/1?q", frame.format("X", "one"), ""), (2, "https://a.example/x/2#top", frame.format("X", "two"), ""),
        (3, "http://a.example/y/1", frame.format("Y", "three"), ""), (4, "http://a.example/y/2", frame.format("Y", "four"), ""),
        (5, "http://b.example/", frame.format("B", "alone"), ""), (6, None, frame.format("N", "null"), ""), (7, "no url", frame.format("N", "odd"), ""),
        (8, "http://c.example/1", frame.format("C", "copy"), ""), (9, "http://c.example/1", frame.format("C", "copy"), ""),
        (10, "http://d.example/1", None, ""), (None, "http://d.example/2", "", ""), (11, "http://d.example/3", PAGE, ""), (11, "http://d.example/3", PAGE, ""),
        (12, "http://d.example/4", PAGE.replace("Last", "New"), ""),
    ]
    pages = spark.createDataFrame(rows, SCHEMA)
    article = text_of(PAGE)
    expected = [(1, "one"), (2, "two"), (3, "three"), (4, "four"), (5, "B logo alone B end"), (6, "N logo null N end"), (7, "N logo odd N end"),
                (8, "C logo copy C end"), (9, "C logo copy C end"), (10, ""), (None, ""), (11, article), (11, article), (12, article.replace("Last", "New"))]
    for per_part in (3, 1000):
        got = extract_text(pages, per_part).collect()
        assert sorted(((r["page_id"], r["text"]) for r in got), key=str) == sorted(expected, key=str)
        assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert extract_text(pages.limit(0)).count() == 0


def test_one_host_with_many_pages_and_a_long_page(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h.example/p/{i:05d}", f"<div>Top</div><p>text {rng.random()}</p><div>End</div>", "") for i in range(700)]
    rows.append((700, "http://h.example/p/00700", "<div>Top</div>" + "".join(f"<p>line {i}</p>" for i in range(20000)) + "<div>End</div>", ""))
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(rows, SCHEMA), 50).collect()}
    assert all(got[i].startswith("text") and "Top" not in got[i] and "End" not in got[i] for i in range(700))
    assert got[700] == " ".join(f"line {i}" for i in range(20000))


def test_whole_table_equals_articles_cut_out(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    for r in pages.join(extract_text(pages).drop("url"), "page_id").collect():
        inner = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        plain = re.sub(r"</?(p|br|h1)>", " ", re.sub("</?b>", "", inner))
        assert r["text"] == " ".join(html.unescape(plain).split())


def test_shared_lines_inside_articles_are_deleted(spark):
    page = "<nav>Home</nav><article><p>Subscribe to our letter</p><h1>Title {0}</h1><p>Story number {0} of many words.</p><p>All rights reserved</p></article>"
    rows = [(i, f"http://h.example/p/{i}", page.format(i), "") for i in range(1, 6)]
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(rows, SCHEMA), 2).collect()}
    assert got == {i: f"Title {i} Story number {i} of many words." for i in range(1, 6)}


def test_article_lines_shared_by_chance_stay(spark):
    page = "<article><h1>Title {0}</h1><p>Story {0} is long.</p><p>{1}</p><p>Other words of {0} follow.</p><p>{2}</p></article>"
    rows = []
    for host in "abc":
        for i in range(6):
            # One line in the middle of all articles, one at the end of two, and a licence on all hosts.
            last = "By chance." if i < 2 and host == "a" else "Free to copy by licence." if i % 2 else f"End of {i}."
            rows.append((len(rows), f"http://{host}.example/p/{i}", page.format(f"{host}{i}", "Said again.", last), ""))
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(rows, SCHEMA), 4).collect()}
    assert got == {row[0]: text_of(row[2]) for row in rows}


@pytest.mark.parametrize(
    "html",
    ["<div>" * 150_000 + "end", "</p></b>" * 120_000 + "end", "<a " * 300_000, "<p>x" + "<!-- " * 200_000 + "> end", "<p><table><tr><td>" + "<div>" * 150_000 + "end",
     "<li>" * 200_000 + "end", "<p>" + "x &amp; " * 200_000, "<" * 500_000, "&" * 500_000, "<p class='" * 100_000],
)
def test_pages_of_a_megabyte_take_linear_time(html):
    started = time.process_time()
    lines = page_lines(html)
    assert time.process_time() - started < 20
    assert not html.endswith("end") or lines[-1][0].endswith("end") or "<!--" in html


def test_markup_that_never_ends():
    assert text_of("<p>a &lt; b</p>c < d &amp; e <b") == "a < b c < d & e <b"
    assert text_of("<p>a</p><!-- open <p>b</p>") == "a"
    assert text_of("<p>a</p><!-- done --><p>b</p><!-- open <p>c</p><!-- more") == "a b"


def test_copies_and_near_copies_are_no_mates(spark):
    frame = "<div>Logo of the site</div><p>Printed on day {0}</p><p>{1} one is a long story.</p><p>{1} two goes on for long.</p><p>{1} three is at the end.</p><div>Made by us</div>"
    rows = [(i, "http://h.example/p/b", frame.format(1, "Bear"), "") for i in range(5)]
    rows += [(10 + i, f"http://h.example/p/b?day={i}", frame.format(i + 2, "Bear"), "") for i in range(4)]
    rows += [(20, "http://h.example/p/a", frame.format(7, "Ant"), ""), (21, "http://h.example/p/c", frame.format(8, "Cat"), "")]
    rows += [(30 + i, f"http://copies.example/{i}", frame.format(i, "Only"), "") for i in range(3)]
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(rows, SCHEMA), 3).collect()}

    def text(day, name):
        return f"Printed on day {day} {name} one is a long story. {name} two goes on for long. {name} three is at the end."

    expected = {i: text(1, "Bear") for i in range(5)} | {10 + i: text(i + 2, "Bear") for i in range(4)}
    expected |= {20: text(7, "Ant"), 21: text(8, "Cat")}
    assert got == expected | {30 + i: f"Logo of the site {text(i, 'Only')} Made by us" for i in range(3)}


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article class="post category-social tag-banner"><p>a</p></article>', "a"),
        ('<div class="content-sidebar-wrap has-sidebar"><main><p>a</p></main><div class="sidebar">b</div></div>', "a"),
        ('<article><section id="related-work"><p>a</p></section><p class="notice">b</p><p class="ad">c</p></article>', "a b"),
        ('<div class="widget"><p>b</p><article><p>a</p></article></div>', "a"),
        ('<article><p>a</p></article><div class="related"><article>b</article></div>', "a"),
        ("<body><form><p>a</p></form></body>", "a"),
        ("<body><form><nav>b</nav><article><p>a</p><input></article></form></body>", "a"),
        ("<p>a</p><form><p>" + "w " * 30 + "</p></form><form><label>b</label></form>", "a " + ("w " * 30).strip()),
        ('<article><p class="ad">b<p>a<ul><li class="share">b<li>c<ul><li>d</ul></ul><p>e</article>', "a c d e"),
        ('<table><tr><td class="ad">b<td>a<tr class="menu"><td>b<tr><td>c</table>', "a c"),
        ('<dl><dt class="nav">b<dd>a</dl>', "a"),
    ],
)
def test_marked_elements_that_hold_the_article(page, text):
    assert text_of(page) == text
