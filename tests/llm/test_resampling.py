"""Importance weights against a plain computation, and the draw against its definition."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from premia.llm import resampling


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(9)
    good, junk = ["the", "house", "was", "built", "Été", "in", "2001", "."], ["!!", "BUY", "now", "###", "$$$", "|", "win"]
    docs, labels = [], []
    for i in range(400):
        fine = rng.random() < 0.7
        words = [rng.choice(good if rng.random() < (0.9 if fine else 0.2) else junk) for _ in range(rng.choice([3, 20, 80]))]
        docs.append((i, " ".join(words), 1.0))
        if i % 2:
            labels.append((i, int(fine)))
    docs += [(None, "the house", 1.0), (900, None, 1.0), (901, "", 1.0), docs[7], docs[7]]
    labels += [(None, 1), (5, None), (12345, 1)]
    return docs, labels, spark.createDataFrame(docs, "doc_id long, text string, draw double"), spark.createDataFrame(labels, "doc_id long, quality int")


def grams(text):
    tokens = [t.encode() for t in re.findall(r"\w+|[^\w\s]+", (text or "").lower())]
    row = resampling.ngrams(pa.array([text or ""]))[0].tolist()
    assert len(row) == max(0, 2 * len(tokens) - 1)
    return row


def test_weights(spark, tables):
    docs, labels, d, table = tables
    target_ids = {i for i, q in labels if i is not None and q}
    raw, target = Counter(), Counter()
    for i, text, _ in docs:
        raw.update(grams(text))
        if i in target_ids:
            target.update(grams(text))
    sizes = [sum(x.values()) + resampling.BUCKETS for x in (target, raw)]
    want = sorted((str(i), round(sum(math.log((target[g] + 1) / sizes[0]) - math.log((raw[g] + 1) / sizes[1]) for g in grams(t)), 6)) for i, t, _ in docs)
    out = resampling.resample(d, table).collect()
    assert sorted((str(r.doc_id), round(r.log_weight, 6)) for r in out) == want


def test_keeps_the_largest_draws(spark, tables):
    _, labels, d, table = tables
    known = [q for i, q in labels if i is not None and q is not None]
    out = resampling.resample(d, table).collect()
    k = round(sum(known) / len(known) * len(out))
    cut = sorted((r.draw for r in out), reverse=True)[k - 1]
    assert all(r.kept == (r.draw >= cut) for r in out)
    again = resampling.resample(d.repartition(3), table).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    assert sum(r.kept for r in resampling.resample(d, table, keep_share=0.0).collect()) == 0
    assert all(r.kept for r in resampling.resample(d, table, keep_share=1.0).collect())


def test_noise_is_gumbel(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    none = spark.createDataFrame([], "doc_id long, quality int")
    x = np.array([r.draw for r in resampling.resample(docs, none, keep_share=0.5).collect()])
    assert abs(x.mean() - 0.5772) < 0.03 and abs(x.var() - math.pi**2 / 6) < 0.06


@pytest.mark.parametrize("k", [1, 2, 10, 500, 999, 1000])
def test_kth_largest(spark, k):
    rng = np.random.default_rng(k)
    values = np.concatenate([rng.normal(size=600), np.repeat([1e-300, -5.0, 3.25], 100), rng.normal(size=100) * 1e9])
    rows = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert resampling.kth_largest(rows, "v", k) == np.sort(values)[::-1][k - 1]


def test_empty_table(spark, tables):
    assert resampling.resample(tables[2].limit(0), tables[3]).count() == 0
