"""Main text of pages: planted parts, the given pages, held-out pages of other layouts."""

import html
import random
import re
import time

import pytest

from kindred.llm import html_blocks, queries

SF = "/root/testdata/sf0.001"

TREE = html_blocks.train(*html_blocks.labelled())


def text(page):
    return html_blocks.main_text(page, TREE)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("<nav>a b</nav><article><h1>T</h1><p>One &amp; two<p> x\n\t y&nbsp;z </article><footer>f</footer>", "T\nOne & two\nx y z"),
        ("<article><p>5 < 6 &lt; 7 &copy &am<b>bold</p>x<br/>y</article>", "5 < 6 < 7 © &ambold\nx\ny"),
        ("<article><script>var a='<p>x</p>';</script><style>p{}</style><p>kept<!-- <p>no</p> --></p></article>", "kept"),
        ("<main><div class='cookie-notice'>We use cookies</div><p>kept</p><aside>no</aside><form>no<input></form>last</main>", "kept\nlast"),
        ("<article><p>kept</p><section id=comments><p>" + "a reader says " * 40 + "</p></section></article>", "kept"),
        ("<article><header><h1>Title</h1><p>By one</p></header><p>kept</p><footer>tags</footer></article>", "Title\nkept"),
        ("<header>Site</header><main><p>one<aside>no</aside><p>two</main>", "one\ntwo"),
        ("<article><div class=adBanner>no</div><div class=header-adjacent>kept</div></article>", "kept"),
        ("<article><p hidden>no</p><p style='display: none'>no</p><div role=navigation>no</div><p>kept", "kept"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
        ("<article><p>" + "word " * 200_000 + "</p></article>", ("word " * 200_000).strip()),
        ("<article><p title='a > b'>x</p><a href=\"q>r\">y</a></article>", "x\ny"),
        ("<title>no</title><noscript>no</noscript><!doctype html><article>yes<textarea><p>no</textarea></article>", "yes"),
    ],
)
def test_planted_parts(page, want):
    assert text(page) == want


def held_out(seed):
    """A page without ``article``: text of paragraphs between lists of links, and its main text."""
    rng = random.Random(seed)
    words = lambda n: " ".join(rng.choice(["tree", "house", "walks", "green", "over"]) for _ in range(n))
    links = lambda n: "".join(f"<li><a href='/x'>{words(rng.randint(1, 3))}</a></li>" for _ in range(n))
    body = [words(rng.randint(20, 120)) for _ in range(rng.randint(2, 6))]
    page = f"<div><ul>{links(6)}</ul></div><div>{''.join(f'<p>{b}</p>' for b in body)}</div><div>{links(5)}</div><div>{words(3)}</div>"
    return page, "\n".join(body)


def test_held_out_layouts():
    right = sum(text(page) == want for page, want in map(held_out, range(200)))
    assert right >= 190


def test_labelled_blocks_are_learned():
    x, y = html_blocks.labelled()
    assert [html_blocks.judge(TREE, r) for r in x.tolist()] == y.astype(bool).tolist()


def article(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1|br)>", inner)]
    return "\n".join(x for x in lines if x)


def test_the_query_returns_the_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in queries.main_text(spark, SF).collect()}
    assert got == {p.page_id: (p.url, article(p.html), len(article(p.html))) for p in pages}


def test_rows_of_all_kinds(spark):
    page = "<article>one</article>"
    rows = [(1, "u", page, "x", 5), (1, "u", page, "x", 5), (None, None, None, None, None), (2, None, "", "", 0), (3, "v", "<" * 1000, "", 0)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(3)
    got = sorted(map(tuple, html_blocks.extract(table).collect()), key=str)
    assert got == sorted([(1, "u", "one", 3), (1, "u", "one", 3), (None, None, "", 0), (2, None, "", 0), (3, "v", "", 0)], key=str)
    assert html_blocks.extract(table.limit(0)).count() == 0


@pytest.mark.parametrize("page", ["<a '" * 100_000, "<" * 300_000, "<!--" * 100_000, "<div>" * 50_000, "<b>" * 50_000 + "</i>" * 50_000, "<b>" * 50_000 + "<div></div>" * 50_000, "<p><i>" * 50_000])
def test_time_is_linear(page):
    start = time.process_time()
    text(page)
    assert time.process_time() - start < 10
