"""Main text of web pages as the maximum-scoring run of their words and tags.

Each page becomes one sequence of words, which score positive, and tags, which score negative; a linear scan finds the
contiguous run with the largest sum, and the text of that run is the main text. The weights come from labelled pages:
a page whose author marked its content (one ``article``, or ``main`` where there is no ``article``) shows which tags
stand inside and outside of content. All labelled pages of the table are counted in Spark; what reaches the driver is
two counts for each element name of the fixed list.

* A tag weighs minus the log odds of standing outside of content; a border of marked content weighs that much times
  the mean number of words of a block, as it is hardly ever crossed.
* A word weighs one; outside of the marked content of a page that has one, and inside of links, it weighs little.
* An element that is page furniture by its name, role or class (menus, headers, footers, sidebars, notices, adverts,
  forms, reader comments, scripts, styles) never gives text. It enters the sequence as a single tag of the least cost,
  as it may stand between two paragraphs as well as outside of the content. Class and id make only block containers
  furniture, and only by a name that consists of nothing but furniture and layout words (``cookie-notice``, ``ad-top``).
  In doubt, where a container's class holds such a word among others (``share-value``) or a class of that kind is that of
  a paragraph, heading or inline tag, the element stays and its words weigh as little as those of links. Anything else
  (``<h2 id="form-validation">``, ``<p class="share-price">``) is content like any other.
* An element around all marked content, or one that only its class makes furniture and that holds a first-level heading
  on a page without marks, is no furniture. Neither is one that only its name makes furniture, such as a form, and that
  holds most words outside of links of a page without marks.

Within the run, character references are decoded, white space inside a block becomes one space, blocks are trimmed and
joined by one line feed, empty blocks vanish. Nothing is cut by length. Ties go to the first, longest run.

Null html counts as empty; pages without words give an empty text. Rows are handled one by one, so repeated rows give
repeated results and null ids and urls stay. Extra columns are ignored. Without labelled pages the prior counts alone
give the weights.
"""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.common import slices, text_of

# Element names of the HTML standard by their use, and usual words of furniture classes.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav object ol optgroup option p pre section "
    "select summary table tbody td textarea tfoot th thead title tr ul video".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var br wbr input link meta".split()
)
FURNITURE = frozenset(
    "head nav header footer aside form menu dialog button select textarea input label iframe noscript template svg object title "
    "script style".split()
)
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice notices notification popup modal overlay "
    "newsletter subscribe signup login share sharing social related recommended comment comments disqus replies respond form "
    "pagination pager toolbar skip".split()
)
LAYOUT_WORDS = frozenset(
    "top bottom left right main site box bar block area panel widget container wrapper wrap inner outer list item items links "
    "button buttons icon icons posts articles stories".split()
)
LANDMARKS = ("article", "main")
#: Blocks that class and id can make furniture, and furniture names that can stand around a whole page.
CONTAINERS = BLOCKS - frozenset("h1 h2 h3 h4 h5 h6 hgroup p pre blockquote dt dd caption figcaption address legend summary br hr".split())
WRAPPERS = frozenset("form header footer aside nav menu dialog".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-z][^\s/>]*+)(?P<rest2>[^>]*+)>?"
    r"|<[!?/][^>]*+>?",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=>\"'/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
_PART = re.compile(r"[a-z]+")

#: What a tag class has been seen inside and outside of content before any labelled page is read.
PRIOR_IN, PRIOR_OUT = 1.0, 2.0
#: The least a tag costs, the worth of a word outside of marked content, and of a word inside of a link.
LEAST, FAINT, LINKED = 1e-4, 1e-3, 0.2
OTHER, ASIDE = "other", "furniture"
_KNOWN = BLOCKS | VOID | INLINE | FURNITURE


class Item(NamedTuple):
    """A piece of a page: a text run (``name`` empty), a tag, or a whole furniture element."""

    name: str
    text: str
    words: int
    marked: bool
    linked: bool
    breaks: bool


class Weights(NamedTuple):
    tags: dict[str, float]
    border: float

    def of(self, item: Item, has_mark: bool) -> float:
        if not item.name:
            return item.words * (LINKED if item.linked else 1.0) * (FAINT if has_mark and not item.marked else 1.0)
        cost = self.tags.get(item.name, self.tags[OTHER])
        return -cost * (self.border if item.name in LANDMARKS else 1.0)


def _by_marks(name: str, rest: str) -> tuple[bool, bool]:
    """Whether role, class or id make an element furniture, and whether they leave that in doubt."""
    doubt = False
    if not rest or name in ("body", "html") or name in LANDMARKS and "comment" not in rest:
        return False, False
    for mark in _ATTRIBUTE.finditer(rest):
        kind, value = mark[1].lower(), (mark[2] or mark[3] or mark[4] or "").lower()
        if kind == "hidden" or kind == "role" and value in FURNITURE_ROLES:
            return True, False
        if kind in ("class", "id"):
            for token in value.split():
                parts = _PART.findall(token)
                if not FURNITURE_WORDS.isdisjoint(parts):
                    whole = all(x in FURNITURE_WORDS or x in LAYOUT_WORDS for x in parts)
                    if whole and name in CONTAINERS:
                        return True, False
                    doubt |= kind == "class" and whole != (name in CONTAINERS)
    return False, doubt


def _is_furniture(name: str, rest: str) -> bool:
    return name in FURNITURE or _by_marks(name, rest)[0]


def _plain_words(tokens: list[tuple[str, bool, str, str]], ends: dict[int, int]) -> list[int]:
    """How many words stand before each token, without those of links and of elements that never give text."""
    before, skip = [0], -1
    for i, (name, closing, rest, text) in enumerate(tokens):
        if name and not closing and i > skip and (name == "a" or name in FURNITURE and name not in WRAPPERS):
            skip = max(skip, ends.get(i, i))
        before.append(before[-1] + (0 if name or i < skip else len(text.split())))
    return before


def _tokens(html: str) -> Iterator[tuple[str, bool, str, str]]:
    """Name, closing flag, attributes and text of each tag and text run; a name is empty for text, ``!`` for what has
    no effect on the text around it."""
    at = 0
    for tag in _TOKEN.finditer(html):
        if tag.start() > at:
            yield "", False, "", html[at : tag.start()]
        at = tag.end()
        name = tag["name"] or tag["name2"]
        if name:
            yield name.lower(), bool(tag["close"] or tag["close2"]), tag["rest"] or tag["rest2"] or "", ""
        else:
            yield "!", False, "", ""
    if at < len(html):
        yield "", False, "", html[at:]


def parse(html: str) -> tuple[list[Item], int]:
    """The page as a sequence of items, and how many elements mark its content."""
    tokens = list(_tokens(html))
    ends = _element_ends(tokens)
    starts = {m: [i for i, t in enumerate(tokens) if t[0] == m and not t[1] and not _is_furniture(m, t[2])] for m in (*LANDMARKS, "h1")}
    marked_by = next((m for m in LANDMARKS if starts[m]), "")
    content = starts.get(marked_by, [])
    borders = set(content)
    before = [] if marked_by else _plain_words(tokens, ends)
    items: list[Item] = []
    skip, inside, links, marks = -1, -1, -1, 0
    for i, (name, closing, rest, text) in enumerate(tokens):
        if i <= skip or name == "!":
            continue
        if not name:
            plain = unescape(text)
            items.append(Item("", plain, len(plain.split()), i < inside, i < links, False))
            continue
        if not closing and _is_furniture(name, rest):
            end = ends.get(i, i)
            holds = (content, starts["h1"])[name not in FURNITURE and not marked_by]
            most = bool(before) and name in WRAPPERS and not _by_marks(name, rest)[0] and 2 * (before[end] - before[i]) > before[-1]
            if not most and (not holds or bisect(holds, end) - bisect(holds, i) < len(holds)):
                skip = end
                items.append(Item(ASIDE, "", 0, i < inside, False, name not in INLINE and name not in ("script", "style")))
                continue
        if i in borders and i >= inside:
            inside, marks = ends.get(i, i), marks + 1
        if not closing and (name == "a" or _by_marks(name, rest)[1]):
            links = max(links, ends.get(i, i))
        if name == "br":
            items.append(Item("br", " ", 0, i < inside, False, False))
        else:
            items.append(Item(name if name in _KNOWN else OTHER, "", 0, i < inside and name != marked_by, False, name in BLOCKS))
    return items, marks


def _element_ends(tokens: list[tuple[str, bool, str, str]]) -> dict[int, int]:
    """For each opening tag the place of its end; what is never closed ends with the element around it, or the page."""
    ends: dict[int, int] = {}
    stack: list[int] = []
    open_by: dict[str, list[int]] = {}
    for i, (name, closing, rest, _) in enumerate(tokens):
        if not name or name == "!" or name in VOID or rest.endswith("/"):
            continue
        if not closing:
            open_by.setdefault(name, []).append(len(stack))
            stack.append(i)
        elif open_by.get(name):
            level = open_by[name][-1]
            while len(stack) > level:
                start = stack.pop()
                ends[start] = i
                open_by[tokens[start][0]].pop()
    for start in stack:
        ends[start] = len(tokens)
    return ends


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and end (exclusive) of the contiguous run with the largest positive sum; (0, 0) if there is none."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    return found


def main_text(html: str | None, weights: Weights) -> str:
    items, marks = parse(html or "")
    low, high = best_run([weights.of(x, marks > 0) for x in items])
    blocks, held = [], []
    for item in items[low:high]:
        if item.breaks:
            blocks.append("".join(held))
            held = []
        else:
            held.append(item.text)
    blocks.append("".join(held))
    return "\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def labelled_counts(html: str | None) -> Counter:
    """Of a labelled page: tags by class inside and outside of content, its words and blocks; else nothing."""
    seen: Counter = Counter()
    items, marks = parse(html or "")
    if marks != 1:
        return seen
    block = 0
    for item in items:
        if item.name:
            seen[item.name, "in" if item.marked else "out"] += 1
        elif item.marked:
            seen["", "words"] += item.words
        if item.marked and item.breaks and block:
            seen["", "blocks"] += 1
            block = 0
        block += item.words if item.marked else 0
    return seen


def learn_weights(pages: DataFrame, html_col: str = "html") -> Weights:
    """Weights from all labelled pages of the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "html"):
                for html in part.column(0).to_pylist():
                    total.update(labelled_counts(html))
        yield pa.RecordBatch.from_pylist(
            [{"name": k[0], "place": k[1], "n": n} for k, n in total.items()], schema=pa.schema([("name", pa.string()), ("place", pa.string()), ("n", pa.int64())])
        )

    counted = pages.select(text_of(html_col).alias("html")).mapInArrow(run, "name string, place string, n long")
    rows = counted.groupBy("name", "place").agg(F.sum("n").alias("n")).collect()
    return weights_from({(r["name"], r["place"]): r["n"] for r in rows})


def weights_from(seen: dict[tuple[str, str], int]) -> Weights:
    tags = {
        name: max(LEAST, math.log((seen.get((name, "out"), 0) + PRIOR_OUT) / (seen.get((name, "in"), 0) + PRIOR_IN)))
        for name in [*sorted(_KNOWN), OTHER]
    }
    tags[ASIDE] = LEAST
    words = (seen.get(("", "words"), 0) + 20) / (seen.get(("", "blocks"), 0) + 1)
    return Weights(tags, max(1.0, words))


def extract(
    pages: DataFrame, weights: Weights | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: its id, url and ``text``; weights are learned from the same pages unless given."""
    learned = weights or learn_weights(pages, html_col)
    given = pages.select(F.col(id_col), F.col(url_col), text_of(html_col).alias("__html"))
    schema = given.select(id_col, url_col, F.lit("").alias("text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__html"):
                texts = [main_text(html, learned) for html in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=[id_col, url_col, "text"])

    return given.mapInArrow(run, schema)
