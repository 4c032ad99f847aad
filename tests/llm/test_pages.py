import random
import time

import pytest

from tierflow.llm.pages import DOUBT, NOISE_BLOCK, SURE, blocks, extract_main, sorted_blocks, suffix_heads, unique_blocks

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy</div>
<header>Site</header><div id="cookie-notice">We use cookies</div><article><h1>Head &amp; tail</h1><p><b>One<br>two
<p>three<i>four</i></p><form><input>Mail</form><section class="comments"><p>first!</p></section></article>
<aside>More</aside><footer>&copy; host</footer>"""


def parts(page, wanted):
    found = blocks(page)
    return " ".join(b.text for b, role in zip(found, sorted_blocks(found)) if role == wanted)


def test_article_without_what_surrounds_it():
    assert parts(PAGE, SURE) == "Head & tail One two threefour"
    assert parts(PAGE, DOUBT) == ""


@pytest.mark.parametrize(
    "page, sure, doubt",
    [
        ("<article>a<p>b", "a b", ""),
        ("<article>a <scr", "a", ""),
        ("<article>a<script>b", "a", ""),
        ("<article>a<!-- b", "a", ""),
        ("<article>a &lt; b &nbsp; c</article>d", "a < b c", ""),
        ("<main>a<nav>b</nav></main>c", "a", ""),
        ("<div class=content>a</div><div>b</div>", "a", ""),
        ("<article>a</b></div>b</article>", "a b", ""),
        ("<article>1 < 2 and 3<4</article>", "1 < 2 and 3<4", ""),
        ('<div class="wrap no-sidebar"><article>a</article></div>', "a", ""),
        ('<div class="banner-layout">b<article>a</article></div>', "a", ""),
        ('<div class="related-posts"><article>b</article></div><article>a</article>', "a", ""),
        ("<article>a<script src=a />code</script>b</article>", "a b", ""),
        ("<article>a<svg />b</article>", "a b", ""),
        ("<article>a <b class=it's>b</b> c's</article>", "a b c's", ""),
        ('<article>a<p title="x > y" data-n=\'<p>\'>b</p></article>', "a b", ""),
        ('<article>a<p class="related-work">b</p><p class="related-links">c</p>d</article>', "a d", "b"),
        ('<article>a<div class="alert alert-info">b <i>c</i></div><div class="user-comments">d</div></article>', "a", "b c"),
        ("<main><p>Intro</p><article>a</article></main>b", "a", "Intro"),
        ("<article>long text</article><article><a href=x>other</a></article>", "long text", "other"),
        ("<article>long text</article><article>short</article>", "long text short", ""),
        ("<div>a</div><nav>b</nav>", "", "a"),
        ("<nav>b</nav>", "", ""),
        ("", "", ""),
    ],
)
def test_markup(page, sure, doubt):
    assert parts(page, SURE) == sure
    assert parts(page, DOUBT) == doubt


@pytest.mark.parametrize("piece", ["<b>x", "</i>", "<div>", "<a =\"", "<p class='", "<", "<!-", "<b>x</i></u>"])
def test_linear_time(piece):
    begin = time.process_time()
    blocks("<i><u>" + piece * 100_000)
    assert time.process_time() - begin < 10


def covered(pages, run):
    """Whether each token is in a run that another page has, by the suffix array."""
    of, at, low, high = suffix_heads(pages, [0] * len(pages), run)
    shared = {tuple(pages[n][a : a + run]) for n, a, x, y in zip(of, at, low, high) if x != y}
    return [
        [any(tuple(p[i : i + run]) in shared for i in range(max(0, j - run + 1), j + 1) if i + run <= len(p)) for j in range(len(p))]
        for p in pages
    ]


def test_heads_match_brute_force():
    draw = random.Random(6)
    for _ in range(20):
        pages = [[draw.choice(["a", "b", "c", ""]) for _ in range(draw.randint(0, 30))] for _ in range(12)]
        groups = [draw.randint(0, 1) for _ in pages]
        of, at, low, high = suffix_heads(pages, groups, 4)
        got = {(groups[n], *pages[n][a : a + 4]): (x, y) for n, a, x, y in zip(*(v.tolist() for v in (of, at, low, high)))}
        want = {}
        for n, page in enumerate(pages):
            for i in range(len(page) - 3):
                if "" not in page[i : i + 4]:
                    key = (groups[n], *page[i : i + 4])
                    want[key] = (want.get(key, (n,))[0], n)
        assert got == want and len(of) == len(got)
    assert covered(["a b c d a b c d".split(), ["x"]], 3)[0] == [False] * 8
    assert covered(["a b c d a b c d".split(), "b c d".split()], 3)[0] == [False, True, True, True, False, True, True, True]


def test_unique_blocks():
    roles = [DOUBT, SURE, NOISE_BLOCK, DOUBT]
    found = ["a b c d", "sure b c d", "noise", "x y"]
    assert unique_blocks(found, roles, lambda head: head == "b c d", 3) == "a sure b c d x y"
    assert unique_blocks(found, roles, lambda head: head in ("a b c", "b c d"), 3) == "sure b c d x y"
    assert unique_blocks([], [], lambda head: True, 3) == ""


def test_hosts_clean_pages_without_landmarks(spark):
    menu = "<div>home news about contact us today</div>"
    rows = [(i, f"http://h.org/{i}", f"{menu}<p>text number {i}</p>") for i in range(5)]
    rows += [(9, "http://other.org/", f"{menu}<p>alone</p>"), (10, "not a url", None), (11, None, PAGE), (11, None, PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 AS host", "2 AS text", "3 AS blocks", "4 AS page", "5 AS unit", "6 AS head", "7 AS roles"
    )
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in extract_main(pages).collect()]
    want = [(i, f"text number {i}") for i in range(5)] + [(9, "home news about contact us today alone"), (10, "")] + [(11, "Head & tail One two threefour")] * 2
    assert sorted(got) == sorted((i, t, len(t)) for i, t in want)
    assert extract_main(pages.limit(0)).collect() == []


@pytest.mark.parametrize("count", [60, 1500])
def test_host_size_does_not_matter(spark, count):
    """Three pages of a host share a notice, whatever the number of others; a remark
    that an article alone has stays, and so does a copied article."""
    notice = "we will be closed for works until the next monday"
    rows = [(i, f"http://h.org/{i}", f"<div>page {i} has words {i} of its own {i}</div>") for i in range(count)]
    for i in (0, count // 2, count - 1):
        rows[i] = (i, f"http://h.org/{i}", rows[i][2] + f"<div>{notice}</div>")
    article = '<article>copied article with many words in it <div class="alert">{}</div></article>'
    rows += [(count, "http://h.org/a", article.format(notice)), (count + 1, "http://h.org/b", article.format("only this one says so here today"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    got = {r["page_id"]: r["text"] for r in extract_main(pages).collect()}
    want = {i: f"page {i} has words {i} of its own {i}" for i in range(count)}
    want[count] = "copied article with many words in it"
    want[count + 1] = "copied article with many words in it only this one says so here today"
    assert got == want
