"""Ranked search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from premia.llm import search

DOCS = "doc_id long, text string, item_id string, rank int, score long, id long"
ITEMS = "item_id string, text string, q int, term string"


def terms(text):
    folded = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
    return re.findall(search.TERM, folded)


def brute(docs, items, most=10):
    vectors = [(row[0], Counter(terms(row[1]))) for row in docs]
    vectors = [(i, v, sum(v.values())) for i, v in vectors if v]
    n_docs, n_all = len(vectors), sum(n for *_, n in vectors)
    df = Counter(t for _, v, _ in vectors for t in v)
    out = []
    for item in items:
        found = []
        for i, v, n in vectors:
            m = 25 + 75 * n * n_docs // n_all
            score = 0
            for t in terms(item[1]):
                if v[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * v[t] // (1000 * v[t] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0))
        for rank, (score, unknown, i) in enumerate(sorted(found)[:most], 1):
            out.append((item[0], rank, None if unknown else i, -score))
    return out


def ranked(spark, docs, items, **kw):
    found = search.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **kw)
    return [tuple(r) for r in found.collect()]


WORDS = [f"w{i}" for i in range(200)] + ["É", "日本", "x1", "don"]


def drawn(rng, n):
    """Words of falling frequency, in mixed case and with punctuation between them."""
    out = []
    for _ in range(n):
        word = WORDS[min(int(rng.paretovariate(0.6)) - 1, len(WORDS) - 1)]
        out.append((word.upper() if rng.random() < 0.2 else word) + rng.choice([" ", ", ", "-", "'", "\n", "  "]))
    return "".join(out)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(17)
    docs = [(i, drawn(rng, rng.choice([0, 1, 5, 30, 200])), "x", 1, 2, 3) for i in range(900)]
    docs += [(2000 + i, "hot w3 copy w9 " * 3, "x", 1, 2, 3) for i in range(400)] + [(900 + i, docs[7][1], "x", 1, 2, 3) for i in range(40)]
    docs += [(5000, None, "x", 1, 2, 3), (5001, " .,", "x", 1, 2, 3), (None, "w190 w9", "x", 1, 2, 3), docs[9], docs[9]]
    docs += [(6000, "long w7 " * 300_000, "x", 1, 2, 3)]
    rng.shuffle(docs)
    items = [(f"i{i}", drawn(rng, rng.choice([1, 6, 40])), 1, "t") for i in range(40)]
    items += [("null", None, 1, "t"), ("none", "unheard", 1, "t"), (None, "w9 W9 w9 copy", 1, "t"), ("i0", "w190", 1, "t"), ("empty", "!", 1, "t")]
    return docs, items


def test_same_as_scoring_everything(spark, tables):
    docs, items = tables
    got = ranked(spark, docs, items)
    assert sorted(map(str, got)) == sorted(map(str, brute(docs, items)))


def test_small_chunks_and_blocks_of_items_do_not_matter(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(search, "BLOCK_TERMS", 200)
    got = ranked(spark, docs[:300], items, most=3)
    assert sorted(map(str, got)) == sorted(map(str, brute(docs[:300], items, 3)))


def test_empty_tables(spark, tables):
    docs, items = tables
    assert ranked(spark, [], items) == [] and ranked(spark, docs[:20], []) == []


def test_trie_bounds_hold_and_spare_documents():
    rng = np.random.default_rng(2)
    n_terms, n = 60, 1500
    vectors = []
    for _ in range(n):
        ranks = np.flatnonzero(rng.random(n_terms) < 0.6 / (1 + np.arange(n_terms) / 6))
        if not len(ranks):
            ranks = np.array([0])
        vectors.append((ranks.astype(np.int32), rng.integers(1, 6, len(ranks)).astype(np.int32)))
    vectors[100:400] = [vectors[100]] * 300
    ids, m = rng.permutation(n).astype(np.int64), rng.integers(26, 300, n)
    trie = search.build_trie(ids, m, vectors, n_terms)
    # Nodes split their parent's documents; the maxima are those of the documents below.
    for i, below in enumerate(trie.children):
        spans = sorted((trie.first[c], trie.last[c]) for c in below)
        if len(below):
            assert spans[0][0] == trie.first[i] and spans[-1][1] == trie.last[i]
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
        else:
            assert trie.last[i] - trie.first[i] <= search.LEAF_DOCS
        docs = slice(trie.first[i], trie.last[i])
        assert trie.least_m[i] == trie.m[docs].min() and trie.least_id[i] == trie.ids[docs].min()
        lo, hi = trie.at[trie.first[i]], trie.at[trie.last[i]]
        want = {t: trie.counts[lo:hi][trie.ranks[lo:hi] == t].max() for t in set(trie.ranks[lo:hi].tolist())}
        got = {t: trie.most[p] for t in range(n_terms) for p in range(trie.term_at[t], trie.term_at[t + 1]) if trie.node[p] == i}
        assert got == want
    spared = 0
    for _ in range(30):
        ranks = np.sort(rng.choice(n_terms, 5, replace=False))
        weights = rng.integers(1, 5000, 5) * (1 + ranks)
        table = np.zeros(n_terms, np.int64)
        table[ranks] = weights
        top: list = []
        spared += n - search.search_trie(trie, ranks, weights, table, top)
        want = []
        for d in range(n):
            score = sum(int(table[r]) * int(search.gains(np.int64(c), m[d])) for r, c in zip(*vectors[d], strict=True))
            want.append((score, -int(ids[d])))
        assert sorted(top) == sorted(w for w in sorted(want)[-10:] if w[0] > 0)
    assert spared > 30 * n / 4
