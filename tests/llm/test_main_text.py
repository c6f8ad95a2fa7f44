import html
import re

import pytest

from wardspan.llm.main_text import best_run, extract_main_text, fit_weights, main_text, shaped
from wardspan.llm.queries import op10_main_text

FOLDER = "/root/testdata/sf0.01"
LONG = "Plain words of a story that goes on for a while and says a few things."
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script><style>p{{}}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><!-- x <p>no</p> -->
<div class="cookie-notice"><p>We use cookies, please accept them all.</p></div>
%s<h2>Head &amp; tail</h2><p>{LONG}<br>Next&nbsp;line.<p>Second <b>bold</b> and <a href='x>y'>linked</a> words. {LONG}
<aside><p>Read more elsewhere.</p></aside><form><input value="q"><button>Send</button></form><ul><li>One point<li>Two point</ul>
<div class="ad">Buy</div><p>Last paragraph here. {LONG}</p>%s
<section id="comments"><p>First! I liked this story a lot, thanks.</p></section><footer>&copy; me</footer></body></html>"""
WANT = f"Head & tail\n{LONG} Next line.\nSecond bold and linked words. {LONG}\nOne point\nTwo point\nLast paragraph here. {LONG}"


@pytest.fixture(scope="module")
def weights(spark):
    return fit_weights(spark.read.parquet(f"{FOLDER}/pages.parquet"))


@pytest.mark.parametrize("marks", [("<article>", "</article>"), ('<main class="post">', "</main>"), ('<div class="content">', "</div>"), ("<article>", "")])
def test_content_without_boilerplate(weights, marks):
    for own in (weights, {}):
        assert main_text(PAGE % marks, own) == WANT


def test_odd_pages(weights):
    for page in ("", "<", "<p", "<!--", "<script>x", "<nav><a href=x>y</a></nav>", "<a href='un>closed>x"):
        assert isinstance(main_text(page, weights), str)
    assert main_text("", weights) == "" and main_text("<nav>a b c</nav>", weights) == ""
    assert main_text("<p>" + "word " * 100_000 + "</p>", weights).count("word") == 100_000


def test_whole_table_against_its_own_marks(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = op10_main_text(spark, FOLDER).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article)
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks]
        want = "\n".join(x for x in lines if x)
        assert r.n_chars == len(r.text) and r.text.replace(" ", "") == want.replace(" ", "")


def _article(page, gap=""):
    """The blocks of a generated page's article; tags inside a block leave ``gap``."""
    article = re.search("<article>(.*)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
    lines = [" ".join(html.unescape(re.sub("<[^>]*>", gap, b)).split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def test_spacing_is_exact(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in op10_main_text(spark, FOLDER).collect():
        assert r.text == _article(pages[r.page_id])


def _bare(page):
    """The page without names and marks: no class, id or role, and plain divisions for all that is named."""
    page = re.sub(r"(<[a-z]+[0-9]?)[^>]*>", r"\1>", page)
    return re.sub(r"(</?)(?:article|main|nav|footer|header|aside)>", r"\1div>", page)


def test_scan_decides_on_pages_without_names_and_marks(spark, weights):
    """Shapes of blocks alone tell the article; without the scan every page keeps its menu, advert and footer."""
    pages = [r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    right = 0
    for page in pages:
        bare, want = _bare(page), _article(page)
        got = main_text(bare, weights)
        right += got == want
        named = [value for kind, value, _, words, named, _ in shaped(bare) if words and not named]
        assert len(" ".join(named).split()) > len(got.split())
    assert right >= 0.98 * len(pages)


def test_best_run_against_all_runs():
    import random

    draw = random.Random(5)
    for _ in range(2000):
        scores = [draw.choice((-3, -2, -1, 0, 1, 2)) for _ in range(draw.randrange(12))]
        best, first, end = best_run(scores)
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        assert best == max([0, *sums]) == sum(scores[first:end])
        assert (first, end) == (0, 0) if not best else end == min(
            j for j in range(1, len(scores) + 1) if any(sum(scores[i:j]) == best for i in range(j))
        )


def test_page_of_boilerplate_shapes_is_read_without_them(weights):
    page = "<body><div>A short page of ten words in one plain division.</div></body>"
    assert main_text(page, weights) == "A short page of ten words in one plain division."


def test_article_that_is_a_comment_is_no_mark(weights):
    page = f'<body><div><p>{LONG}</p></div><article class="comment"><p>Nice one, thanks.</p></article><article></article></body>'
    assert main_text(page, weights) == LONG


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", PAGE % ("<article>", "</article>")), (2, None, "")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = extract_main_text(frame)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "u", ""), (2, None, ""), (2, None, ""), (None, "u", WANT)], key=str)
    assert extract_main_text(frame.where("false")).count() == 0


@pytest.mark.parametrize("tag", ["svg", "math", "template"])
def test_page_goes_on_after_an_unclosed_tag(tag):
    inside = f'<div class="content"><{tag} width="9"><{tag}>'
    assert main_text(PAGE % (inside, "</div>"), {}) == WANT
