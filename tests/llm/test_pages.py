"""Main text: declared noise, repeated branches of a site's tree, broken markup, odd rows."""

import html
import re

from ticksmith.llm import pages as pg

SF = "/root/testdata/sf0.01"


def test_given_pages_against_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in pg.main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1|h2)\b[^>]*>", article)
        want = "\n".join(x for x in (" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", p))).split()) for p in parts) if x)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_repeated_branches_of_a_site_go(spark):
    def page(k):
        return (f'<body><div class="hd"><div><a href="/">Home</a> <a>About us</a></div></div><div id="c{k}"><h2>Title {k}</h2>'
                f"<p>Story number {k} of the day.<p>More of {k}</div><div class='lower'><p>Call us any time</p></div></body>")

    rows = [(k, f"http://site.example/{k}", page(k)) for k in range(12)] + [(99, "http://other.example/", page(99))]
    got = {r["page_id"]: r["text"] for r in pg.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[3] == "Title 3\nStory number 3 of the day.\nMore of 3"
    # a site of one page has nothing to compare with
    assert got[99].startswith("Home About us\nTitle 99") and got[99].endswith("Call us any time")


def test_mirrored_articles_stay(spark):
    same = "<html><body><nav>menu</nav><article><h1>T</h1><p>Same story everywhere</p></article></body></html>"
    rows = [(k, "https://mirror.example/a", same) for k in range(9)]
    out = pg.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert len(out) == 9 and {r["text"] for r in out} == {"T\nSame story everywhere"}


def test_declared_noise_and_broken_markup():
    def text(source):
        return pg.Page(source).text()

    assert text("<p>One <b>two</b>,<i>x</i><p>three<script>if (a<b) '</p>'</script><form>f</form><aside>s</aside>") == "One two,x\nthree"
    assert text('<main><header><h1>H</h1></header>a<div class="cookie-notice">ck</div><section id="comments"><p>c</p></section></main>') == "H\na"
    assert text("<header>top</header><p hidden>h</p><p style='display: none'>n</p><p>&lt;b&gt; &amp; &#233; &am</p>") == "<b> & é &am"
    assert text("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><p>e</article><footer>f") == "a\nb\nc\nd\ne"
    assert text("<article>open <!-- never closed") == "open"
    assert text('<p title="a > b">x</p><p class="unclosed>y') == "x\ny"
    assert text("a < b <3 c") == "a < b <3 c"
    assert text("<div>" * 3000 + "deep" + "</div>" * 10) == "deep"
    assert pg.site("HTTPS://user@Ex.COM:80/a") == "ex.com" and pg.site(None) == pg.site("nonsense") == ""


def test_odd_rows(spark):
    rows = [(1, None, None, 7), (2, "http://a/", "", 7), (2, "http://a/", "", 7), (None, "x", "<p>t", 7), (3, "http://a/", "<p>" + "long " * 50_000, 7)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, paths int")
    out = sorted(((r["page_id"] or 0, r["text"], r["n_chars"]) for r in pg.main_text(df).collect()))
    assert out[0] == (0, "t", 1) and out[1] == (1, "", 0) and out[2] == out[3] == (2, "", 0) and out[4][2] == 249_999
    assert pg.main_text(df.where("page_id > 100")).count() == 0


ARTICLE = "<article><h1>Title</h1><p>The story of the day, told at some length for everybody.</p></article>"
WANT = "Title\nThe story of the day, told at some length for everybody."


def test_names_that_hold_a_noise_word_take_nothing_with_them():
    for source in (
        f"<div class='layout with-sidebar'>{ARTICLE}</div>", f"<div id='page' class='has-nav'>{ARTICLE}</div>",
        ARTICLE.replace("<article>", "<article class='post share-enabled'>"), f"<form id='aspnetForm'>{ARTICLE}</form>", f"<div class='overlay modal'>{ARTICLE}</div>",
        f"<div class='main-menu'>Menu</div>{ARTICLE}<div class='sidebar'><p>Side</p></div>",
        f"{ARTICLE}<div class='post-comments'><article class='comment'><p>{'I liked it. ' * 50}</p></article></div>",
    ):
        assert pg.Page(source).text() == WANT, source
    assert pg.Page("<div class='social-science'><p>On society.</p></div>").text() == "On society."
    # a class does not take most of a page with it, a tag does
    assert pg.Page("<div class='notice'><p>All there is on this page.</p></div><p>x").text() == "All there is on this page.\nx"
    assert pg.Page("<nav>Home News</nav><p>x").text() == "x"


def test_a_teaser_does_not_replace_unmarked_text():
    teaser, story = "<article><a href='/x'>More</a><p>Read next</p></article>", "<p>A long story that no element marks, with much more to say.</p>"
    assert pg.Page(f"<div id='content'><h1>T</h1>{story * 4}</div>{teaser}").text().startswith("T\nA long story") and "Read" not in pg.Page(f"<div>{story}</div>{teaser}").text()
    # of several articles those stay that compare with the best
    assert pg.Page(f"<article>{story * 3}</article>{teaser}<article>{story * 2}</article>").text().count("A long story") == 5
    assert pg.Page("<article><a>one</a></article><div><a>two</a></div>").text() == "one\ntwo"
    assert pg.Page("<p>one two <span class='ad'>buy</span> three<button>go</button></p>").text() == "one two three"


def test_the_tree_decides_on_what_no_mark_tells(spark):
    """The same pages as parts of a site and alone: branches that repeat go only where the site shows it."""
    box = "<div class='x'><p>Follow the station on all its channels every day</p><p>Call us any time you like, we listen</p></div>"
    story = [f"<div class='y'><p>{'word%d tells of day %d ' % (k, k) * 6}</p></div>" for k in range(10)]
    teaser = "<article class='z'><p>Our best picture of the whole year is right here for you to see and share with all</p></article>"
    rows = [(k, "http://a.example/", f"<body>{box}{teaser}{story[k]}</body>") for k in range(10)]
    rows += [(100 + k, f"http://b{k}.example/", f"<body>{box}{teaser}{story[k]}</body>") for k in range(10)]
    got = {r["page_id"]: r["text"] for r in pg.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for k in range(10):
        assert got[k] == ("word%d tells of day %d " % (k, k) * 6).strip()
        assert "Follow the station" in got[100 + k]


def brute_importance(pages):
    """path -> importance over the pages of one host, by plain loops."""
    import math

    seen, styles, texts = {}, {}, {}
    for source in pages:
        for path, kind, feature in set(pg.page_features(pg.Page(source))):
            table = texts if kind else styles
            table.setdefault(path, {}).setdefault(feature, 0)
            table[path][feature] += 1
    out, content = {}, {}
    for path, found in styles.items():
        m = sum(found.values())
        seen[path] = m
        if path in texts:
            each = [math.log(n) for n in texts[path].values()]
            content[path] = (len(each), 1.0 if m < 2 else max(0.0, 1 - sum(each) / len(each) / math.log(m)))
    for path, found in styles.items():
        m = seen[path]
        shown = 1.0 if m < 2 else -sum(n / m * math.log(n / m) for n in found.values()) / math.log(m)
        below = [c for p, c in content.items() if p == path or p.startswith(path + "/")]
        if below and m >= pg.MIN_PAGES:
            out[path] = (1 - pg.GAMMA) * shown + pg.GAMMA * sum(n * c for n, c in below) / sum(n for n, _ in below)
    return out


def test_importance_equals_plain_loops(spark):
    import random

    rng = random.Random(5)
    words = "alpha beta gamma delta".split()

    def branch(depth):
        if depth == 0:
            return f"<p class='{rng.choice('xy')}'>{' '.join(rng.choice(words) for _ in range(rng.randint(1, 2)))}</p>"
        return f"<div class='{rng.choice('abc')}'>{''.join(branch(depth - 1) for _ in range(rng.randint(1, 3)))}</div>"

    pages = [f"<body>{branch(3)}</body>" for _ in range(30)]
    df = spark.createDataFrame([(k, "http://s.example/", h) for k, h in enumerate(pages)], "page_id bigint, url string, html string")
    (row,) = pg.low_branches(pg.style_tree(df), low=0.0, weighed=2.0).collect()
    want = {p: v for p, v in brute_importance(pages).items() if p.rsplit("/", 1)[-1].split(".")[0] not in ("html", "body")}
    assert set(row["paths"]) == set(want) and all(abs(row["paths"][p] - want[p]) < 1e-9 for p in want)


def test_bad_markup_takes_linear_time():
    import time

    start = time.process_time()
    for source in (
        "<" + "a" * 200_000, "<b>" * 20_000 + "</i>" * 20_000, "<i><p>" + "<b>" * 20_000 + "</i>" * 20_000, "<b><h1>x</h1>" * 20_000,
        '<a b="' * 5_000, "<td>" * 10_000 + "</tr>" * 10_000, "<ul><li>" * 10_000, "<p><table>" * 10_000, "</x>" * 50_000,
    ):
        pg.Page(source).text()
    assert time.process_time() - start < 40
