"""Page text: against the marked articles, the scan against all runs, other templates, odd pages."""

import html
import random
import re
import time

import pytest

from tessera.llm import extract as ex
from tessera.llm.extract import best_run, extract, main_text

SCHEMA = "page_id long, url string, html string, text int, N_CHARS string"


def article(page):
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r.page_id: r for r in extract(pages, fit_pages=50).collect()}
    for p in pages.collect():
        assert rows[p.page_id].text == article(p.html) and rows[p.page_id].n_chars == len(article(p.html))
        assert rows[p.page_id].url == p.url


def test_best_run_against_all_runs():
    rng = random.Random(2)
    for _ in range(500):
        scores = [rng.choice([-2, -1, -0.5, 0.5, 1, 3]) for _ in range(rng.randint(0, 12))]
        a, b = best_run(scores)
        sums = [(sum(scores[i:j]), j - i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        top = max(sums, default=(0, 0))
        assert (sum(scores[a:b]), b - a) == (top if top[0] > 0 else (0, 0))


@pytest.fixture(scope="module")
def weights(spark):
    return ex.fit_weights(spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html"))


def test_other_templates(weights):
    page = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><div id="menu"><a href=x>Home</a> <a>About us now</a></div>
    <div class="content"><h1>Real title</h1><p>First para with some words &amp; more &#8212; x.</p><div class="cookie-notice">We use cookies please accept</div>
    <p>Second<br>para here is
    long   enough.</p><form><label>Name</label><input></form><!-- no --><p>End.<script>var x = "<p>not</p>";</script></p></div>
    <div class="sidebar"><p>Some other text here in sidebar with words</p></div><div id="comments"><p>Great article I liked it a lot thanks</p></div><footer>c 2020</footer></body>"""
    want = "Real title\nFirst para with some words & more — x.\nSecond\npara here is long enough.\nEnd."
    assert main_text(page, weights) == want == main_text(page, {})


def test_odd_pages(spark, weights):
    assert [main_text(p, weights) for p in ("", "<p>", "<!-- open", "<script>x", "<nav>a b c</nav>")] == [""] * 5
    assert main_text("<article><p>one two<p>three</b> four <i>fi</i>ve", weights) == "one two\nthree four five"
    many = "<article>" + "<div>" * 3000 + "words here " * 20_000
    assert len(main_text(many, weights).split()) == 40_000
    pages = [(1, None, None, 1, "x"), (2, "u", "", 1, "x"), (None, "u", "<article><p>x y z</p></article>", 1, "x"), (3, "u", "<p>a &lt; b", 1, "x"), (3, "u", "<p>a &lt; b", 1, "x")]
    found = extract(spark.createDataFrame(pages, SCHEMA)).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in found) == [(0, "x y z", 5), (1, "", 0), (2, "", 0), (3, "a < b", 5), (3, "a < b", 5)]
    assert extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_time_is_linear_in_broken_markup(weights):
    for page in ("<" * 100_000, "<a " * 50_000, "<a b='" * 30_000, "<!--" * 30_000, "</p" * 50_000, "&" * 100_000):
        began = time.process_time()
        main_text(page, weights)
        assert time.process_time() - began < 10


def test_names_do_not_empty_an_article(weights):
    long = "This paragraph of the article says a good deal about its subject and goes on for some time. " * 3
    body = f"<p>{long}</p><p>{long}</p>"
    want = "\n".join([long.strip()] * 2)
    for name in ("search", "c-copyright", "widget", "share"):
        assert main_text(f"<article><div class='{name}'>{body}</div></article>", weights) == want == main_text(f"<article><div class='{name}'>{body}</div></article>", {})
    assert main_text(f"<body><nav><a href=x>Home</a> <a>About us</a><article>{body}</article></body>", weights) == want  # a menu without its end
    page = f"<main><h1>Title of it</h1>{body}<div class='search'><p>{long}</p></div><div class='comments'>{body}</div></main>"
    assert main_text(page, weights) == "Title of it\n" + want
    comments = f"<article><p>Short text of a few words in one line.</p><div class='comments'>{body}{body}</div></article>"
    assert main_text(comments, weights) == "Short text of a few words in one line."


def test_names_that_only_hold_a_word_of_the_list(weights):
    text = "First words of it that say something here."
    pages = {
        f"<div class='layout has-sidebar'><article><p>{text}</p></article></div>": text,
        f"<form id='search'><div class='widget'><main><p>{text}</p></main></div></form>": text,
        f"<article><h2 id='related-work'>Related work</h2><p id='share-prices'>{text}</p><section id='search-algorithms'><p>Many are known.</p></section></article>": f"Related work\n{text}\nMany are known.",
        f"<article><div class='article-header'><h1>Real title</h1></div><p>{text}</p><div class='share-prices'><p>One two three</p></div></article>": f"Real title\n{text}\nOne two three",
        f"<article><p>{text}</p><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> it is.</p><svg><title>T</title><g><path d='M0'/><text>Year 2020</text></g></svg></article>": f"{text}\nSo x=2 it is.\nYear 2020",
        # marks on blocks of their own still hold, in an article and beside it
        f"<article><p>{text}</p><div class='sidebar'><p>no no</p></div><div class='share-buttons'>no no</div><p>And the end of it.</p></article>": f"{text}\nAnd the end of it.",
        f"<main><p>{text}</p><div class='related-posts'><article><p>A teaser of some words</p></article></div></main><aside><article>Another teaser</article></aside>": text,
        f"<main><p>{text}</p></main><div id='comments'><article class='comment'><p>I liked it a lot thanks</p></article></div>": text,
    }
    for page, want in pages.items():
        assert main_text(page, weights) == want == main_text(page, {})
