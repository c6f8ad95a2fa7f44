"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags. Tags score below zero. A word scores by
the shape of its block (element, length, whether in a link): the log-odds,
counted over pages that mark their article, that a word of such a shape belongs
to it, names and marks not looked at. What names and marks say is added to that.
One linear scan finds the contiguous run with the greatest sum; its words, less
those of elements named as boilerplate inside it, are the main text. So a page
without marks and names is cut by the shapes of its blocks alone.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marked pages that weights are counted on, about, however many there are.
LABELLED_PAGES = 5000

# Element names by role.
SILENT = frozenset("script style noscript template textarea select option title svg math iframe object canvas audio video button head datalist".split())
BOILER = frozenset("nav header footer aside form menu dialog fieldset".split())
MARKS = frozenset(("article", "main"))
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
#: Tags with weights of their own; all others share one.
KNOWN = SILENT | BOILER | MARKS | BLOCKS | VOID | INLINE | {"html", "body"}
#: Bound of a word's weight by shape, and what a mark adds or a name takes off: more than a shape can make up for.
LIMIT = 4.0
EVIDENCE = 8.0
#: Words of class, id or role that name boilerplate.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|breadcrumbs?|sidebar|side|footer|header|"
    r"masthead|comments?|replies|reply|respond|disqus|notices?|cookies?|consent|alert|popup|modal|newsletter|subscribe|"
    r"subscription|share|sharing|social|related|recommended|widget|search|login|signup|toolbar|pagination|pager|"
    r"contentinfo|complementary|navigation)(?:$|[\s_-])",
    re.I,
)
COMMENT = re.compile(r"(?:^|[_-])(?:comments?|replies|reply|teaser|related|ads?)(?:$|[_-])", re.I)
#: Words that say what a page has or lacks rather than what an element is.
STATE = re.compile(r"(?:has|with|without|no|is|js)[_-]", re.I)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</?([A-Za-z][A-Za-z0-9:-]*)"
    r"((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+(?=>)|[^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_RAW = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in ("script", "style", "textarea", "title", "iframe", "noscript", "template", "svg", "math")}


def _boiler(tag: str, attributes: str) -> bool:
    """Whether an element is boilerplate by its name or by how its class, id or role names it."""
    if tag in BOILER:
        return True
    if tag in ("html", "body", "main") or "=" not in attributes:
        return False
    named = [word for m in _ATTRIBUTE.finditer(attributes) for word in (m[2] or m[3] or m[4] or "").split()]
    rule = COMMENT if tag == "article" else NAMES
    return any(rule.search(word) and not STATE.match(word) for word in named)


def tokens(page: str) -> Iterator[tuple[str, str, str, bool, bool]]:
    """(kind, value, place, named, marked) of a page, in order.

    A tag gives ("tag", name, "", ...), other characters ("text", them, place,
    ...); place is the block and whether in a link. ``named`` tells whether an
    element named as boilerplate holds the token, ``marked`` whether an open
    article or main element does. Silent elements and comments give nothing but
    their tags.
    """
    stack: list[tuple[str, bool]] = []
    boiler = marks = links = 0
    unclosed: set[str] = set()
    block, at, size = "", 0, len(page)
    while at < size:
        match = _TOKEN.search(page, at)
        if (end := match.start() if match else size) > at:
            yield "text", page[at:end], f"{block}|{'link' if links else ''}", boiler > 0, marks > 0
        if not match:
            return
        at = match.end()
        if not match[1]:
            continue
        tag, closing = match[1].lower(), page[match.start() + 1] == "/"
        if not closing and tag in _RAW and not match[2].endswith("/"):
            close = None if tag in unclosed else _RAW[tag].search(page, at)
            yield "tag", tag, "", boiler > 0, marks > 0
            if close:
                at = close.end()
                continue
            unclosed.add(tag)
            if tag in ("svg", "math", "template"):  # the page goes on without the tag
                continue
            if tag != "noscript":
                return
        if tag == "a":
            links = 0 if closing else 1
        elif tag in BLOCKS or tag in SILENT:
            if closing:
                if any(name == tag for name, _ in stack):
                    while stack:
                        name, bad = stack.pop()
                        boiler -= bad
                        marks -= name in MARKS
                        if name == tag:
                            break
                block = ""
            else:
                if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "hr") or tag[0] == "h" and tag[1:].isdigit():
                    links = 0
                    block = tag
                else:
                    bad = tag in SILENT or _boiler(tag, match[2])
                    stack.append((tag, bad))
                    boiler += bad
                    marks += tag in MARKS
                    block = "" if tag in BOILER or tag in ("div", "section", "body", "article", "main") else tag
        yield "tag", tag, "", boiler > 0, marks > 0


def shaped(page: str) -> list[tuple[str, str, str, int, bool, bool]]:
    """(kind, value, shape, words, named, marked) of a page's tokens.

    The shape of a word is its place and how many words its block has: few
    (under 5), a line (under 17), a paragraph (under 65) or more. That of a tag
    is its name.
    """
    sequence = list(tokens(page))
    lengths, block = [0], []
    for kind, value, *_ in sequence:
        if kind == "tag" and value in BLOCKS:
            lengths.append(0)
        n = len(value.split()) if kind == "text" else 0
        lengths[-1] += n
        block.append((len(lengths) - 1, n))
    made = []
    for (kind, value, place, named, marked), (at, n) in zip(sequence, block):
        size = sum(lengths[at] >= least for least in (5, 17, 65))
        shape = f"{place}|{size}" if kind == "text" else f"<{value if value in KNOWN else 'other'}>"
        made.append((kind, value, shape, n, named, marked))
    return made


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        for page in batch.column(0).to_pylist():
            for kind, _, shape, words, named, marked in shaped(page or ""):
                if kind == "tag":
                    seen[shape, marked] += 1
                elif words:
                    seen[shape, marked and not named] += words
    for (key, inside), n in seen.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([key]), pa.array([inside]), pa.array([n], pa.int64())], names=["key", "inside", "n"]
        )


def fit_weights(pages: DataFrame, html_col: str = "html", labelled: int = LABELLED_PAGES) -> dict[str, float]:
    """Weights of words by shape and of tags, from about ``labelled`` pages with an article or main element.

    The pages are those with the least hash, so the choice doesn't depend on
    order. Shapes and tags come of fixed lists of elements, so there are a few
    hundred weights at most.
    """
    marked = pages.select(F.col(f"`{html_col}`").alias("html")).where(
        F.col("html").rlike("(?i)<(article|main)[\\s>]")
    )
    key = F.pmod(F.xxhash64("html"), F.lit(1 << 20))
    total = marked.count()
    sample = marked.where(key < F.lit(int((1 << 20) * min(1.0, labelled / max(total, 1)))))
    found = sample.mapInArrow(_counts, "key string, inside boolean, n long").groupBy("key", "inside").agg(F.sum("n").alias("n"))
    odds: dict[str, list[int]] = {}
    for key, inside, n in found.collect():
        odds.setdefault(key, [0, 0])[inside] = n
    weights = {}
    for key, (out, within) in odds.items():
        if key[0] == "<":
            weights[key] = -0.2 - out / (out + within)
        elif out + within >= 20:
            weights[key] = max(-LIMIT, min(LIMIT, log((within + 0.5) / (out + 0.5))))
    return weights


def _by_shape(weights: dict[str, float], shape: str) -> float:
    """The weight of a word by the shape of its block; one for shapes that no labelled page had."""
    if (own := weights.get(shape)) is not None:
        return own
    block, link, _ = shape.split("|")
    return -0.5 if link else 2.0 if block else 0.5


def _score(weights: dict[str, float], shape: str, words: int, named: bool, marked: bool | None) -> float:
    """Sum of the weights of the words of one text; ``marked`` is None on a page without marks.

    A named element amid the article costs a bounded amount, as it is cut
    later: it must not part the article.
    """
    if not words or named and marked:
        return -0.1 * words
    own = _by_shape(weights, shape)
    if marked is not None:
        return words * (own + EVIDENCE if marked else min(-LIMIT, own - EVIDENCE))
    return max(-12.0, words * (own - EVIDENCE)) if named else words * own


def best_run(scores: Iterable[float]) -> tuple[float, int, int]:
    """(sum, first, end) of the contiguous run with the greatest sum above zero; (0, 0, 0) if there is none.

    Of runs with equal sums it is the one that ends first, and of these the
    longest start that isn't a run of sum zero or less.
    """
    best = total = 0.0
    first = start = stop = 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, first = 0.0, k
        total += score
        if total > best:
            best, start, stop = total, first, k + 1
    return best, start, stop


def main_text(page: str, weights: dict[str, float]) -> str:
    """Blocks of the best-scoring run of ``page``, one per line; empty if no run scores above zero.

    Where no run does by ``weights``, as all blocks have shapes of boilerplate,
    the scan is made once more without weights of shapes.
    """
    sequence = shaped(page)
    any_mark = any(words and marked and not named for _, _, _, words, named, marked in sequence)

    def scan(weights: dict[str, float]) -> tuple[float, int, int]:
        return best_run(
            weights.get(shape, -0.7) if kind == "tag" else _score(weights, shape, words, named, marked if any_mark else None)
            for kind, _, shape, words, named, marked in sequence
        )

    best, start, stop = scan(weights)
    if not best and weights:
        best, start, stop = scan({key: w for key, w in weights.items() if key[0] == "<"})
    blocks: list[str] = []
    line: list[str] = []
    for kind, value, _, _, named, marked in sequence[start:stop]:
        if kind == "tag":
            if value in BLOCKS:
                blocks.append("".join(line))
                line = []
            elif value == "br":
                line.append(" ")
        elif not named and marked == any_mark:
            line.append(value)
    blocks.append("".join(line))
    clean = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def extract_main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """One row per row of ``pages``: ``<id_col>``, ``<url_col>``, text.

    White space inside a block becomes one space, blocks stand in page order
    one a line, character references are decoded. A page without main text, an
    empty or null one has an empty text. ``weights`` are those of
    ``fit_weights``, fitted on ``pages`` itself where not given. Null ids and
    urls and repeated rows are kept; other columns are ignored; an empty table
    gives no rows. Pages are read whole.
    """
    weights = fit_weights(pages, html_col) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page or "", weights) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"]
            )

    rows = pages.select(*[F.col(f"`{c}`").alias(n) for c, n in ((id_col, "id"), (url_col, "url"), (html_col, "html"))])
    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "url")]
    rows = rows.mapInArrow(run, f"id {kinds[0]}, url {kinds[1]}, text string")
    return rows.withColumnsRenamed({"id": id_col, "url": url_col})
