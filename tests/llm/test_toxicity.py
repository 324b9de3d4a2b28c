"""Toxicity models against a plain computation, and accuracy on held-out rows."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from premia.llm import toxicity

BAD = ["idiot", "scum", "été"]


def corpus(n=600, seed=5):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.25
        w = [rng.choice(["a", "the", "of", "Zeit", "x9"]) + rng.choice(["", "s", f"q{rng.randrange(999)}"]) for _ in range(rng.choice([5, 30, 200]))]
        if toxic:
            w += rng.choices(BAD, k=1 + len(w) // 10)
            rng.shuffle(w)
        docs.append((i, " ".join(w) + rng.choice(["", "!"]), "en"))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    return (
        spark.createDataFrame(docs + [(None, "idiot idiot", "x"), (9001, None, "x"), (9001, None, "x"), (9002, "", "x"), (9003, "?!", "x")], "doc_id long, text string, toxicity string"),
        spark.createDataFrame(labels + [(None, 1), (3, None), (77_777, 1), (4, labels[4][1])], "doc_id long, toxic int"),
    )


def test_same_likelihoods_as_a_plain_computation(spark, tables):
    model = toxicity.learn(*tables)
    docs, labels = corpus()
    label = dict(labels)
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i in label}
    n, d, left = [Counter(), Counter()], [Counter(), Counter()], defaultdict(set)
    kept, done = [], set()
    for i, text, _ in docs:
        if fold[i] and (text, label[i]) not in done:
            done.add((text, label[i]))
            kept.append(i)
    split = lambda t: [w.decode() for w in toxicity_words(t)]
    for i, text, _ in docs:
        if i in kept and fold[i] != 4:
            w = split(text)
            n[label[i]].update(w)
            d[label[i]].update(set(w))
            for a, b in zip(["", *w], w, strict=False):
                left[b].add(a)
    p = sum(label[i] for i in kept if fold[i] != 4) / sum(fold[i] != 4 for i in kept)
    z = {}
    for w in left:
        e = (d[0][w] + d[1][w]) * p
        z[w] = abs(d[1][w] - e) / math.sqrt(max(e * (1 - p), 0.25))
    telling = [w for w in left if z[w] >= 4.5]
    assert set(BAD) <= set(telling) and len(model.words) == len(telling)
    total = [sum(x.values()) for x in n]
    freed = [1 - sum(max(n[c][w] - 0.75, 0) / total[c] for w in telling) for c in (0, 1)]
    assert model.other == pytest.approx(math.log(freed[1] / freed[0]))
    # The number of different left neighbours is an estimate from 64 slots.
    shared = {w: (len(x) + 0.5) / sum(len(y) + 0.5 for y in left.values()) for w, x in left.items()}
    for w in BAD:
        chance = [max(n[c][w] - 0.75, 0) / total[c] + freed[c] * shared[w] for c in (0, 1)]
        assert model.means(pa_string([w]))[0] == pytest.approx(math.log(chance[1] / chance[0]), abs=0.3)
    mixed = model.means(pa_string(["idiot plain words here", "idiot"]))
    assert mixed[0] == pytest.approx((mixed[1] + 3 * model.other) / 4)


def toxicity_words(text):
    from premia.llm.decontaminate import words

    return words(text)


def pa_string(texts):
    import pyarrow as pa

    return pa.array(texts)


def test_held_out_rows_nulls_and_empty_texts(spark, tables):
    docs, labels = tables
    model = toxicity.learn(docs, labels)
    rows = toxicity.score(docs, model).withColumn("fold", toxicity.fold_of()).collect()
    truth = dict(corpus()[1])
    assert len(rows) == docs.count()
    held = [(r.toxicity >= 0.5) == bool(truth[r.doc_id]) for r in rows if r.doc_id in truth and r.fold == 0]
    assert sum(held) / len(held) > 0.97
    assert all(0 <= r.toxicity <= 1 for r in rows)
    assert all(r.toxicity < 0.5 for r in rows if r.doc_id in (9001, 9002, 9003))
    assert [r.toxicity >= 0.5 for r in rows if r.doc_id is None] == [True]
    assert all(r.fold == zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows if r.doc_id is not None)


def test_labels_of_held_out_rows_change_nothing(spark, tables):
    docs, labels = tables
    turned = labels.withColumn("toxic", F.when(toxicity.fold_of() == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.learn(docs, labels), toxicity.learn(docs, turned)
    assert (a.words == b.words).all() and a.ratios == pytest.approx(b.ratios) and (a.cut, a.slope) == (b.cut, b.slope)


def test_bounds_and_missing_classes(spark, tables):
    docs, labels = tables
    assert len(toxicity.learn(docs, labels, most_expressions=2).words) == 2
    few = toxicity.learn(docs, labels, most_labels=300)
    assert few.share is None
    for part in (labels.filter("toxic = 0"), labels.limit(0)):
        model = toxicity.learn(docs, part)
        assert {r.toxicity for r in toxicity.score(docs, model).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), few).count() == 0


def test_left_neighbours_are_counted_beyond_any_slots(spark):
    texts = [(i, f"n{i % 5000} idiot n{i % 700} calm", 1) for i in range(10_000)]
    rows = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    counts = {r.word: r for r in toxicity._counts(rows).collect()}
    word = lambda w: counts[int(word_hash(w).view("int64")[0])]
    assert word("idiot").followed == 5000 and word("calm").followed == 700
    assert (word("idiot").n1, word("idiot").d1, word("calm").d0) == (10_000, 10_000, 0)
    again = spark.createDataFrame([(1, "a b a b b", 0), (2, "b a", 1)], "doc_id long, text string, toxic int")
    counts = {r.word: r for r in toxicity._counts(again).collect()}
    assert [tuple(word(w))[1:] for w in "ab"] == [(2, 1, 1, 1, 2), (3, 1, 1, 1, 3)]


def word_hash(w):
    folded, starts, stops, _ = toxicity.word_runs(pa_string([w]), toxicity._FOLD)
    return toxicity.run_hashes(folded, starts, stops)


def test_many_blocks_score_like_one(spark, tables, monkeypatch):
    docs, labels = tables
    whole = toxicity.learn(docs, labels)
    key = lambda model: sorted(((r.doc_id is None, r.doc_id, r.toxicity) for r in toxicity.score(docs, model).collect()), key=str)
    expected = key(whole)
    monkeypatch.setattr(toxicity, "BLOCK", 2)
    parts = toxicity.learn(docs, labels)
    assert len(parts.words) == len(whole.words) > 2 and (parts.cut, parts.slope) == (whole.cut, whole.slope)
    for a, b in zip(key(parts), expected, strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2])


def test_no_default_bound_on_the_expressions():
    import inspect

    assert inspect.signature(toxicity.learn).parameters["most_expressions"].default is None
