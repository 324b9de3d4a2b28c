"""Suffix orders against plain sorting, and removed bytes against every string of every document."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from premia.llm import repeats
from premia.llm.suffixes import suffix_orders


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.lists(st.integers(1, 4), max_size=50)).map(lambda x: [min(x[0], y) for y in x[1]]), min_size=1, max_size=8))
def test_suffix_orders(texts):
    texts = [[*t, 0] for t in texts]
    begins = np.cumsum([0, *map(len, texts)])
    got = suffix_orders(np.array([x for t in texts for x in t]), begins)
    for i, t in enumerate(texts):
        assert (got[begins[i] : begins[i + 1]] - begins[i]).tolist() == sorted(range(len(t)), key=lambda p: t[p:])


def test_suffix_orders_of_periodic_and_long_texts():
    rng = random.Random(2)
    texts = [[1] * 300 + [0], [1, 2] * 200 + [0], [2, 1] * 200 + [0], [rng.randrange(1, 256) for _ in range(3000)] + [0], [0], [3, 1, 2] * 100 + [3, 1, 1] * 50 + [0]]
    begins = np.cumsum([0, *map(len, texts)])
    got = suffix_orders(np.array([x for t in texts for x in t]), begins)
    for i, t in enumerate(texts):
        assert (got[begins[i] : begins[i + 1]] - begins[i]).tolist() == sorted(range(len(t)), key=lambda p: t[p:])


def brute(rows, length):
    first = {}
    raws = [(t or "").encode() for _, t, *_ in rows]
    for (i, *_), raw in zip(rows, raws, strict=True):
        if i is not None:
            for p in range(len(raw) - length + 1):
                s = raw[p : p + length]
                first[s] = min(first.get(s, i), i)
    out = []
    for (i, *_), raw in zip(rows, raws, strict=True):
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if i is not None and first[raw[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        spans, p = [], 0
        while p < len(raw):
            q = p
            while q < len(raw) and gone[q] == gone[p]:
                q += 1
            if gone[p]:
                spans.append((p, q))
            p = q
        out.append((i, len(raw), spans, bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return sorted(out, key=str)


def rows_of(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the ", "of ", "é", "tion", "a", "\n", "zz9", "As "])
    text = lambda n: "".join(word() for _ in range(n))
    shared = [text(rng.choice([8, 20, 60])) for _ in range(6)] + ["As " * 40, "x" * 90]
    rows = []
    for i in rng.sample(range(500), 60):
        parts = [text(rng.choice([0, 3, 30])) if rng.random() < 0.5 else rng.choice(shared)[rng.choice([0, 0, 3]) :] for _ in range(rng.choice([1, 3, 6]))]
        rows.append((i, "".join(parts), "x", 1))
    rows += [(rows[0][0] + 1000, rows[0][1], "x", 1), (rows[1][0], rows[1][1], "x", 1), (rows[2][0], rows[3][1] + "!", "x", 1)]
    return rows + [(None, rows[4][1], "x", 1), (2000, None, "x", 1), (2001, "", "x", 1), (2002, shared[2], "x", 1), (-5, shared[2] * 2, "x", 1)]


@pytest.mark.parametrize("seed, length, most", [(1, 50, 5000), (2, 20, 5000), (3, 20, 2), (4, 9, 5), (5, 50, 1)])
def test_removed_bytes(spark, seed, length, most, monkeypatch):
    monkeypatch.setattr(repeats, "BATCH_BYTES", 500 if seed == 2 else 1 << 20)
    rows = rows_of(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, key int").repartition(5)
    out = repeats.remove_repeats(docs, length=length, most_documents=most).collect()
    got = sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in out), key=str)
    assert got == brute(rows, length)


@pytest.mark.parametrize("seed, strings, known", [(6, 40, 1 << 22), (7, 1 << 17, 30), (8, 7, 10)])
def test_anchors_of_many_bytes_in_few_documents(spark, seed, strings, known, monkeypatch):
    """One delimiter is the anchor of thousands of pieces in two long documents; groups are bounded by bytes."""
    monkeypatch.setattr(repeats, "STRINGS", strings)
    monkeypatch.setattr(repeats, "MOST_KNOWN", known)
    rng = random.Random(seed)
    field = lambda: "<--delimiter-->!" + "".join(rng.choice("abc") for _ in range(rng.choice([3, 20, 36])))
    common = [field() for _ in range(8)]
    rows = [(i, "".join(rng.choice(common) if rng.random() < 0.3 else field() for _ in range(60)), "x", 1) for i in (3, 1)] + rows_of(seed)[:10]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, key int").repartition(3)
    out = repeats.remove_repeats(docs, most_bytes=100).collect()
    got = sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in out), key=str)
    assert got == brute(rows, 50)


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_shared_anchors(spark, batch):
    """Anchors of several documents, however their rows fall into batches; from too many rows on they pass unjudged."""
    rng = random.Random(batch)
    rows = [(a, rng.randrange(3) if a % 3 else a, a, rng.randrange(20)) for a in range(-20, 20) for _ in range(rng.choice([1, 2, 5, 30]))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = repeats._shared_anchors(spark.createDataFrame(rows, "anchor long, doc long, th long, size long"), 10, 80).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = sorted(map(tuple, found))
    groups = {a: [r for r in rows if r[0] == a] for a in range(-20, 20)}
    many = {a: len(g) > 10 or sum(r[3] for r in g) > 80 for a, g in groups.items()}
    shared = {a for a, g in groups.items() if len({r[1] for r in g}) > 1}
    assert [r for r in got if r[0] in shared] == sorted((*r[:3], many[r[0]]) for r in rows if r[0] in shared)
    assert {r[0] for r in got} - shared <= {a for a in many if many[a]}


def test_anchors_are_dealt_once(spark, monkeypatch):
    """Shared anchors come from one pass over the texts and one exchange by anchor, without a join of them."""
    plans = {}
    stored = repeats.stored

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, label)

    monkeypatch.setattr(repeats, "stored", seen)
    docs = spark.createDataFrame(rows_of(9), "doc_id long, text string, spans string, key int")
    repeats.remove_repeats(docs).count()
    assert "Join" not in plans["repeat-documents"] and plans["repeat-documents"].count("hashpartitioning(anchor") == 1


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_smallest_documents_of_pieces(spark, batch):
    """Pieces that a smaller document has go at once; the others count as rows of their anchor."""
    rng = random.Random(batch)
    rows = [(a, rng.randrange(6), rng.randrange(1 if a % 3 else 4) << repeats.LOW_BITS + 4 | rng.randrange(2)) for a in range(-20, 20) for _ in range(rng.choice([1, 2, 5, 30]))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = [tuple(r) for r in repeats._shared_anchors(spark.createDataFrame(rows, "anchor long, doc long, th long"), 1000, 1 << 20).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    least = {}
    for a, doc, th in rows:
        least[a, th >> repeats.LOW_BITS] = min(doc, least.get((a, th >> repeats.LOW_BITS), doc))
    first = [r for r in rows if r[1] == least[r[0], r[2] >> repeats.LOW_BITS]]
    shared = {a for a in range(-20, 20) if len({r[1] for r in first if r[0] == a}) > 1}
    assert sorted(r[:3] for r in found if r[3] is None) == sorted(r for r in rows if r not in first)
    assert sorted(r for r in found if r[3] is not None) == sorted((*r, False) for r in first if r[0] in shared)


def sent_by(spark, monkeypatch, rows, **limits):
    """The rows of the pieces' table and of what their groups find, and the result."""
    kept, stored = {"repeat-pieces": [], "repeat-found": []}, repeats.stored

    def seen(df, label):
        out = stored(df, label)
        kept.setdefault(label, []).extend(out.collect())
        return out

    monkeypatch.setattr(repeats, "stored", seen)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    out = repeats.remove_repeats(docs, **limits).collect()
    got = sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in out), key=str)
    assert got == brute(rows, 50)
    return kept["repeat-pieces"], kept["repeat-found"]


def test_copies_send_no_bytes(spark, monkeypatch):
    """Of equal texts hashes alone meet: the bytes of none of them are exchanged."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(2000)) for _ in range(10)]
    pieces, _ = sent_by(spark, monkeypatch, [(100 * k + i, t) for k in range(3) for i, t in enumerate(texts)])
    assert not [r for r in pieces if r.key is not None] and len({r.doc for r in pieces}) == 20


def test_only_pieces_that_differ_are_sent(spark, monkeypatch):
    """Texts that share a passage send the pieces at its ends, not its inner ones."""
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = text(3000)
    pieces, _ = sent_by(spark, monkeypatch, [(i, text(300) + passage + text(300)) for i in range(20)])
    assert 0 < sum(len(r.piece) for r in pieces if r.key is not None) < 20 * 500


def test_a_repeated_passage_is_found_once(spark, monkeypatch):
    """What a group finds at meeting places of one text is one row of it."""
    monkeypatch.setattr(repeats, "ROUNDS", 3)
    pieces, found = sent_by(spark, monkeypatch, [(i, "Is onhe. " * (40 + i) + "xyz " * i) for i in range(1, 5)], most_bytes=100)
    assert len(pieces) > 1000 and len(found) <= 4 * 30
