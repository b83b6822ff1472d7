from __future__ import annotations

import random
from collections import defaultdict

from feedloom.llm import html_text
from feedloom.llm.html_text import CHROME, CONTENT, DOUBTFUL, LONG, OPEN, Block


def text(page):
    return html_text.main_text(html_text.blocks_of(page), lambda _: False)


def test_containers():
    page = '<html class="header-x"><head><title>t</title></head><body><header><a>Home</a></header><div id="cookie-notice">We use</div><main><article><header><h1>T</h1><span>by x</span></header><p>a&amp;b&nbsp; <b>c</b>d<p>e<aside>s</aside><div class="comments"><p>no</p></div><form>f</form><script>if(a<b){"</p>"}</script></article></main><section id="comments"><article class="comment">bad</article></section><footer>x</footer></body>'
    assert text(page) == "T a&b cd e"
    assert text("") == "" and text("plain") == "plain" and text("<p>cut <b>of") == "cut of" and text("<article><p>one<br>two &am") == "one two &am"
    assert text('<body><div class="ad">AD</div><div><p>One two</p>x <i>y</i></div><!-- c -->z<') == "One two x y z"
    assert text("<article>a</article><nav>m</nav><article>b <p hidden>h</p></article>") == "a b"


def test_boilerplate_of_a_host(spark):
    notice = " ".join(f"n{i}" for i in range(20))
    rows = [(i, f"http://h.example/{i}", f"<body><div>{notice}</div><div>own {i} words {i * 7} here</div></body>", "x") for i in range(4)]
    rows += [(10, "http://other.example/", f"<body><div>{notice}</div></body>", "x"), (11, None, None, "x"), (12, "http://h.example/c", rows[0][2], "x"), (12, "http://h.example/c", rows[0][2], "x"), (13, "http://h.example/a", f"<article><p>{notice}</p></article>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, found string").repartition(3)
    got = html_text.main_texts(pages).collect()
    assert len(got) == len(rows)
    seen = {r.page_id: (r.text, r.n_chars) for r in got}
    assert [seen[i][0] for i in range(4)] == [f"own {i} words {i * 7} here" for i in range(4)]
    assert seen[10][0] == notice and seen[11] == ("", 0) and seen[12][0] == "own 0 words 0 here" and seen[13][0] == notice
    assert html_text.main_texts(pages.limit(0)).count() == 0


def test_runs_inside_a_block():
    tokens = [f"t{i}" for i in range(30)]
    blocks = [Block(CHROME, " ".join(tokens[:6])), Block(OPEN, " ".join(tokens[6:]))]
    at = lambda *places: {" ".join(tokens[i : i + LONG]) for i in places}.__contains__
    assert html_text.main_text(blocks, at(0)) == " ".join(tokens[6:])
    assert html_text.main_text(blocks, at(10)) == " ".join(tokens[6:10] + tokens[22:])
    assert html_text.main_text(blocks, at(4, 10, 18)) == ""


def test_names_inside_the_content_leave_doubt():
    page = '<article><p>one</p><div class="legal-notice">two <a href="x">three</a> four</div><div class="related"><a>five</a> <a>six</a></div><div class="ad">no</div><h2 class="copyright">seven</h2></article>'
    assert text(page) == "one two three four seven"
    zones = {b.text: b.zone for b in html_text.blocks_of(page)}
    assert zones["two three four"] == DOUBTFUL and zones["one"] == CONTENT and zones["no"] == CHROME
    marked = {html_text.WHOLE + "two three four", html_text.WHOLE + "one"}
    assert html_text.main_text(html_text.blocks_of(page), marked.__contains__) == "one seven"
    assert text('<div class="legal-notice">two</div><p>x</p>') == "x"


def test_open_text_beside_an_article():
    teasers = "<div><h1>Head</h1><p>" + "long body of the page " * 5 + "</p></div><article>teaser</article>"
    assert text(teasers) == "Head " + ("long body of the page " * 5).strip() + " teaser"
    assert text("<article>" + "a real article " * 9 + "</article><div>aside</div>") == ("a real article " * 9).strip()


def brute(rows):
    """What each page keeps, by comparing all beginnings of all suffixes of all distinct pages of a host."""
    where = defaultdict(set)
    for _, url, page in rows:
        tokens, ends = [], []
        blocks = html_text.blocks_of(page)
        for b in blocks:
            some = b.text.split(" ") if b.zone != CONTENT else []
            if 0 < len(some) < LONG and not b.heading:
                where[url.split("/")[2], "block", b.text].add(page)
            tokens += some
            ends.append(len(tokens))
        for i in range(len(tokens) - LONG + 1):
            where[url.split("/")[2], "run", " ".join(tokens[i : i + LONG])].add(page)
    out = []
    for i, url, page in rows:
        host = url.split("/")[2]
        found = lambda x, h=host: len(where[(h, "block", x[1:]) if x[0] == html_text.WHOLE else (h, "run", x)]) > 1
        out.append((i, html_text.main_text(html_text.blocks_of(page), found)))
    return sorted(out)


def test_array_against_brute_force(spark):
    r = random.Random(6)
    say = lambda k: " ".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=k))
    shared = [say(k) for k in (3, 8, 15, 40, 60)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.randint(1, 7)):
            words = r.choice(shared) if r.random() < 0.5 else say(r.randint(1, 80))
            parts.append(r.choice(["<div>%s</div>", "<p>%s</p>", "<nav>%s</nav>", "<h2>%s</h2>", "<p>x %s</p>", '<article>%s<div class="notice">%s</div></article>'][: 6 if i % 3 else 5]).replace("%s", words))
        rows.append((i, f"http://h{i % 3}.example/{i}", "".join(parts)))
    rows += [(100 + i, f"http://h0.example/copy{i}", rows[0][2]) for i in range(30)] + [(200, "http://h1.example/long", "<p>" + say(20_000) + "</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = sorted((x.page_id, x.text) for x in html_text.main_texts(pages).collect())
    assert got == brute(rows)
    assert any(t != html_text.main_text(html_text.blocks_of(p), lambda _: False) for (_, t), (_, _, p) in zip(got, rows, strict=False))
