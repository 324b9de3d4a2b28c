"""The grid order join against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from premia.llm import embjoin


def brute(rows, least=0.98):
    n = len(rows)
    vectors = []
    for i, v, label, *_ in rows:
        ok = i is not None and label is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)
        vectors.append(np.array(v, float) if ok else None)
    linked = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            a, b = vectors[i], vectors[j]
            if i != j and a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b):
                linked[i, j] = a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least
    root = np.arange(n)
    while True:
        new = np.minimum(root, np.where(linked, root[None], n).min(axis=1))
        if (new == root).all():
            break
        root = new
    least_id = {}
    for i in range(n):
        if rows[i][0] is not None:
            least_id[root[i]] = min(least_id.get(root[i], rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], int(linked[i].sum()), least_id.get(root[i]) if rows[i][0] is not None else None) for i in range(n)), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = []
    for label in (1, 2, 2, 3):
        for _ in range(6):
            centre = rng.normal(size=12)
            spread = rng.choice([0.02, 0.05, 0.09])
            out += [(v.astype(np.float32).tolist(), label) for v in centre + rng.normal(size=(rng.integers(1, 12), 12)) * spread * np.linalg.norm(centre)]
        # A chain of small turns.
        a, b = rng.normal(size=(2, 12))
        out += [((a * np.cos(t) + b * np.sin(t)).astype(np.float32).tolist(), label) for t in np.arange(0, 1.5, 0.11)]
    out += [(out[0][0], 1), (out[0][0], 1), ([x * 4 for x in out[0][0]], 1), (out[0][0], 7), (out[0][0][:5], 1), (out[0][0][:5], 1)]
    out += [(None, 1), (None, 1), ([], 1), ([0.0] * 12, 1), ([0.0] * 12, 1), ([float("nan")] * 12, 1), ([float("inf")] * 12, 1), (out[0][0], None), (out[0][0], None), ([None] + out[0][0][1:], 1)]
    ids = rng.permutation(len(out)).tolist()
    made = [(i, v, label, 0, b"x") for i, (v, label) in zip(ids, out, strict=True)]
    return made + [(None, out[0][0], 1, 0, b"x"), made[2], made[2]]


@pytest.mark.parametrize("block, fanout", [(256, 32), (4, 2), (1, 3)])
def test_links_and_components(spark, rows, block, fanout, monkeypatch):
    monkeypatch.setattr(embjoin, "BLOCK", block)
    monkeypatch.setattr(embjoin, "FANOUT", fanout)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n int, class binary")
    out = embjoin.near_vectors(table).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=str) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)


def test_distant_blocks_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(embjoin, "BLOCK", 16)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 8))
    vectors = [(int(i), (centres[i % 40] + rng.normal(size=8) * 0.01).tolist(), 1) for i in range(1600)]
    seen = []
    compare = embjoin._near_blocks
    monkeypatch.setattr(embjoin, "_near_blocks", lambda levels: seen.append((levels[0].count(), (p := compare(levels)).count())) or p)
    out = embjoin.near_vectors(spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int"))
    assert out.filter("kept").count() <= 40
    blocks, pairs = seen[0]
    assert pairs < 0.25 * blocks * (blocks + 1) / 2


def test_empty_table(spark):
    assert embjoin.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_long_labels_that_differ_late_are_not_equal(spark):
    stem = "/a/long/path/" * 8
    rows = [(i, [1.0, 2.0, 3.0], f"{stem}{i % 2}") for i in range(6)] + [(6, [1.0, 2.0, 3.0], stem)]
    out = embjoin.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == brute(rows)


def test_very_large_and_very_small_vectors_are_linked(spark):
    base = np.array([1.0, 2.0, 3.0])
    turned = np.array([1.0, 2.0, 3.1])
    vectors = [base, base * 1e200, turned * 1e307, base * 1e-200, turned * 1e-300, -base * 1e250, np.array([0.0, 0.0, 5e-324])]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    out = embjoin.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == [(i, 4, 0) for i in range(5)] + [(5, 0, 5), (6, 0, 6)]
