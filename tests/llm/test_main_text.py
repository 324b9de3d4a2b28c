"""Main text of pages with known content, and the best run against all runs."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from premia.llm import main_text as M

WEIGHTS = M.weights_from({("furniture", "out"): 6000, ("article", "out"): 4000, ("body", "out"): 4000, ("p", "in"): 20000, ("h1", "in"): 2000, ("", "words"): 300000, ("", "blocks"): 10000})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=30))
def test_best_run_is_the_largest_sum(scores):
    low, high = M.best_run([float(x) for x in scores])
    assert sum(scores[low:high]) == max([0, *(sum(scores[a:b]) for a in range(len(scores)) for b in range(a, len(scores) + 1))])


WORDS = "alpha beta gamma delta epsilon &amp; caf&eacute; 5&lt;6 x&#39;y &notin; zeta eta theta".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


FURNITURE = [
    '<nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></ul></nav>',
    "<header><h2>Site name</h2><p>Slogan of the site that is rather long and says a lot</p></header>",
    '<aside class="x"><p>Side remark with many words in it, more than some paragraphs have at all</p></aside>',
    '<div class="cookie-notice">We use cookies <button>OK</button></div>',
    '<div id="ad-top"><div>Buy now</div><p>cheap</div>',
    '<form action="/s"><input name=q><label>Search all</label></form>',
    '<script>var a = "<p>no</p>"; if (a < 3 && b > 4) {}</script><style>p > b {color: red}</style>',
    "<!-- <p>hidden comment</p> -->",
    '<section class="comments"><article class="comment"><p>First! I like this very much indeed, thank you</p></article></section>',
    '<div role="navigation">A B C</div><p hidden>secret</p>',
    "<footer><p>&copy; 2020 nobody &middot; all rights reserved</p></footer>",
]


@pytest.mark.parametrize("mark", ["article", "main", ""])
@pytest.mark.parametrize("seed", range(6))
def test_furniture_goes_and_content_stays(mark, seed):
    from html import unescape

    rng = random.Random(seed)
    title, paragraphs = sentence(rng, 4), [sentence(rng, rng.choice([1, 7, 30])) for _ in range(8)]
    middle, around = [x for x in FURNITURE if rng.random() < 0.3], lambda: "".join(rng.sample(FURNITURE, 4))
    inner = "".join(f"<p>{p.replace(' ', rng.choice([' ', '\n  ', '<br>', ' <b>']), 1)}" + rng.choice(["", "</p>"]) + (rng.choice(middle) if middle and rng.random() < 0.3 else "") for p in paragraphs)
    body = f"<h1>{title}</h1>{inner}"
    body = f"<{mark}>{body}</{mark}>" if mark else f"<div>{body}</div>"
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{around()}{body}{around()}</body></html>"
    assert M.main_text(page, WEIGHTS) == "\n".join(" ".join(unescape(x).split()) for x in [title, *paragraphs])


def test_inline_tags_do_not_split_words_and_breaks_are_white_space():
    assert M.main_text("<article><p>on<b>e</b> two<br/>three<!-- x --> fo<script>1</script>ur</p><p> </p></article>", WEIGHTS) == "one two three four"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div", ">", "<", "a b", "&am", "&#x41;", '"', "'", "<!--", "-->", "<script>", "</script>", "<article>", "</article>", "<nav>", "\n"]), max_size=40).map("".join))
def test_broken_markup_never_fails(html):
    assert isinstance(M.main_text(html, WEIGHTS), str)


def test_long_broken_pages_take_linear_time():
    for piece in ("<p>", "<div><p>a", '<a href="', "<nav>", "</div>", "<b", "&amp;", "<!--"):
        M.main_text(piece * 60_000, WEIGHTS)


def test_rows_nulls_and_labels(spark):
    page = "<body><nav>menu</nav><article><h1>A</h1><p>b c</article></body>"
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (None, None, page, "x"), (2, "v", None, "x"), (3, "w", "", "x"), (4, "z", "<p></p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(M.extract(pages).collect(), key=str)
    assert [r.text for r in got if r.page_id in (1, None)] == ["A\nb c"] * 3
    assert [r.text for r in got if r.page_id in (2, 3, 4)] == [""] * 3
    assert M.extract(pages.limit(0)).count() == 0
    learned = M.learn_weights(pages)
    assert learned.tags["article"] > learned.tags["h1"]


@pytest.mark.parametrize(
    "inner",
    [
        '<h2 id="form-validation">Form validation</h2>',
        '<section id="related-work"><h2>Related work</h2><p>Others did this before us</p></section>',
        '<h3 id="sharing-data">Sharing data</h3>',
        '<p class="share-price">The price of a share rose</p>',
        '<p>He said <em class="ad-hoc">yes indeed</em> twice</p>',
        '<div class="comment-syntax">Comments start with two slashes</div>',
    ],
)
@pytest.mark.parametrize("mark", ["article", "div"])
def test_names_that_only_hold_a_furniture_word_are_content(inner, mark):
    page = f"<body><nav>menu one</nav><{mark}><h1>Title</h1><p>alpha beta gamma delta</p>{inner}<p>epsilon zeta eta theta</p></{mark}><footer>end</footer></body>"
    words = " ".join(M._TOKEN.sub(" ", inner).split())
    assert " ".join(M.main_text(page, WEIGHTS).split()) == f"Title alpha beta gamma delta {words} epsilon zeta eta theta"
    last = page.replace("<p>epsilon zeta eta theta</p>", "")
    assert " ".join(M.main_text(last, WEIGHTS).split()) == f"Title alpha beta gamma delta {words}"


def test_a_form_around_the_page_is_no_furniture():
    inner = "<nav><a href=x>menu one</a></nav><div><h1>Title</h1><p>alpha beta gamma delta</p><p>epsilon zeta</p></div><select><option>x y z</select><footer>end</footer>"
    assert M.main_text(f'<body><form method="post" id="aspnet">{inner}</form></body>', WEIGHTS) == "Title\nalpha beta gamma delta\nepsilon zeta"
    assert M.main_text("<body><p>alpha beta gamma delta</p><form><p>your name</p></form></body>", WEIGHTS) == "alpha beta gamma delta"
