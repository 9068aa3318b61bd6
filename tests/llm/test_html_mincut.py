"""Extraction: pages of the tables against their markup, hand-made pages, cuts
against all labellings, and edge cases."""
import html
import itertools
import random
import re

import pytest

from llm_help import SF01
from tessera.llm import html_mincut as H


@pytest.fixture(scope="module")
def weights():
    return H.train()


def test_pages_of_the_tables(spark):
    got = {r["page_id"]: r["text"] for r in H.extract(spark.read.parquet(f"{SF01}/pages.parquet")).collect()}
    for r in spark.read.parquet(f"{SF01}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split())
                 for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[r["page_id"]] == "\n".join(x for x in parts if x)


def test_unseen_layouts(weights):
    exact = 0
    for page, content in H.seed_pages(120, seed=99):
        exact += H.main_text(page, weights).split("\n") == content
    assert exact >= 108


def test_hand_made_page(weights):
    page = '''<html><body class="has-sidebar"><div id=top><a href=/>Home</a> | <a href=/x>About us</a></div>
<div role=alert>We use cookies to improve your visit.</div><div><h1>Title &amp; more</h1><p>First   paragraph
of the text,&nbsp;with a <b>bold word in it.<p>Second one is here. It has two sentences.<div class="advert">Buy
now! Cheap things here.</div><script>if (a < b) { x = "<p>no</p>"; }</script><p>Third paragraph goes on a little
longer than that one did.</p><!-- no > comment --></div><section class="comments"><h3>Comments</h3><p>Great
article, thanks a lot for writing it up!</p></section><form><label>Email</label><input><p>Subscribe to get
news.</p></form><footer>&copy; 2024</footer></body>'''
    assert H.main_text(page, weights).split("\n") == [
        "Title & more", "First paragraph of the text, with a bold word in it.",
        "Second one is here. It has two sentences.",
        "Third paragraph goes on a little longer than that one did."]


def test_min_cut_is_the_cheapest_labelling():
    rnd = random.Random(2)
    for _ in range(150):
        n = rnd.randint(1, 9)
        costs = [rnd.randint(-9, 9) for _ in range(n)]
        edges = [(i, j, rnd.randint(0, 6)) for i in range(n) for j in range(i + 1, n) if rnd.random() < 0.4]

        def price(kept):
            return sum(-c if c < 0 and k else c if c > 0 and not k else 0 for c, k in zip(costs, kept)) + \
                sum(w for i, j, w in edges if kept[i] != kept[j])
        assert price(H.min_cut(costs, edges)) == min(map(price, itertools.product((False, True), repeat=n)))


def test_edge_cases(spark, weights):
    long_page = "<article>" + "<p>A paragraph of a very long page, which goes on.</p>" * 5000 + "</article>"
    rows = [(1, None, None, "a"), (2, "u", "", "b"), (None, "u", "<p>", "c"), (3, "u", "<" * 2000, "d"),
            (4, "u", long_page, "e"), (4, "u", long_page, "e"), (5, "u", "<script>x", "f"), (6, "u", "</p></div>" * 9, "g")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extract(df).collect()
    assert len(got) == len(rows)
    assert all(r["text"].count("\n") == 4999 for r in got if r["page_id"] == 4)
    assert all(r["text"] == "" for r in got if r["page_id"] in (1, 2, 5, 6))
    assert H.extract(df.where("false")).count() == 0


def test_head_without_its_end_tag(weights):
    text = "A first paragraph of the article that is long enough, with commas, to count as text."
    more = "A second paragraph of the article goes on, and it says a little more than that one."
    article = f"<article><p>{text}</p><p>{more}</p></article>"
    for head in ("<title>x</title><body>", "<title>x</title>", "<meta charset=utf-8><title>x</title><style>p {}</style>"
                 "<script>var a;</script><body class=page>", "<title>x</title></head><body>", ""):
        assert H.main_text(f"<html><head>{head}{article}", weights) == f"{text}\n{more}"
    for none in ("<html><head><title>x</title>", "<html><head><title>x</title><link rel=y></head></html>"):
        assert H.main_text(none, weights) == ""


def test_text_of_math_and_object_is_read(weights):
    page = "<article><p>The area is given by <math><mi>a</mi><mo>=</mo><mi>bc</mi></math> for each of the shapes.</p>" \
           "<p><object data=x>The drawing shows how the parts of the shape fit together, side by side.</object></p></article>"
    got = H.main_text(page, weights)
    assert "bc" in got and "fit together, side by side." in got


def test_odd_pages_take_time_in_proportion(weights):
    """Very many inline tags, very deep pages, and very many blocks that lean
    either way: twice the page is about twice the time."""
    import time
    inline = lambda n: "<article><p>" + "<b>word</b> <i> </i>" * n + "</p></article>"
    deep = lambda n: "<div>" * n + "<p>A paragraph of the text, far inside.</p>" * 9 + "</div>" * n
    mixed = lambda n: "<div>" + "<p>A paragraph that goes on, with some words in it.</p><p><a href=x>Menu</a></p>" * n + "</div>"
    for make, n in ((inline, 25_000), (deep, 25_000), (mixed, 2_500)):
        spent = []
        for k in (1, 2):
            page, began = make(n * k), time.process_time()
            H.main_text(page, weights)
            spent.append(time.process_time() - began)
        assert spent[1] < 20 and spent[1] < 4 * spent[0] + 1, (n, spent)
    assert H.main_text(inline(50_000), weights).count("word") == 50_000


def test_chain_cut_of_many_nodes():
    import time
    rnd = random.Random(4)
    began = time.process_time()
    costs = [rnd.randint(-500, 500) for _ in range(4000)]
    kept = H.min_cut(costs, [(i, i + 1, rnd.randint(0, 400)) for i in range(3999)])
    assert len(kept) == 4000 and time.process_time() - began < 20
