"""Near-duplicate components against all pairs of full sets, and the guarantee of the index."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from premia.llm import neardup


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def up(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        x, y = sets[i], sets[j]
        if rows[i][0] is not None and rows[j][0] is not None and x and y and 100 * len(x & y) >= 85 * len(x | y):
            root[up(i)] = up(j)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[up(i)] = min(least.get(up(i), row[0]), row[0])
    return [(row[0], len(sets[i]), None if row[0] is None else least[up(i)]) for i, row in enumerate(rows)]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(17)
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([12, 40, 150, 400]))
        for _ in range(rng.choice([1, 4, 9])):
            out.append(" ".join(edited(rng, base, rng.choice([0, 0, 1, 2, 4, 8]))))
    # A chain in which only neighbours are similar, and many documents around one centre.
    chain = rng.choices(vocabulary, k=300)
    for _ in range(40):
        out.append(" ".join(chain))
        chain = edited(rng, chain, 2)
    centre = rng.choices(vocabulary, k=200)
    out += [" ".join(edited(rng, centre, rng.choice([1, 2, 3, 4]))) for _ in range(60)]
    # A long passage that unlike documents share.
    passage = rng.choices(vocabulary, k=120)
    out += [" ".join(passage + rng.choices(vocabulary, k=rng.choice([15, 40, 120]))) for _ in range(40)]
    out += ["", " \t", None, "one", "ONE", "one two three", "One\ntwo\x0bthree", "é é é é é é", "É é é é é é", "a b c d e", "a b c d e a b c d e"]
    ids = list(range(1000, 1000 + len(out)))
    rng.shuffle(ids)
    made = [(i, t, "x", 0) for i, t in zip(ids, out, strict=True)]
    return made + [made[3], (None, made[3][1], "y", 1), (None, None, "y", 1), (5, made[20][1] + " more", None, 1), (6, made[20][1], None, 1)]


@pytest.mark.parametrize("block", [256, 8])
def test_components_of_all_pairs(spark, rows, block, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", block)
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, key int")
    out = neardup.near_duplicates(docs).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str)
    assert got == sorted(brute(rows), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_every_signature_pair_within_the_distance_meets():
    rng = np.random.default_rng(1)
    left = rng.integers(0, 1 << 16, (400, neardup.SYMBOLS)).astype(np.uint16)
    right = left.copy()
    for row in right:
        places = rng.choice(neardup.SYMBOLS, neardup.DISTANCE, replace=False)
        row[places] += 1
    assert (neardup.index_keys(left) == neardup.index_keys(right)).any(axis=1).all()


def test_symbols_estimate_similarity():
    rng = np.random.default_rng(2)
    for share in (0.5, 0.85):
        sets = []
        for _ in range(200):
            both = rng.integers(0, 1 << 63, 400, np.uint64)
            n = int(400 * share)
            rest = (400 - n) // 2
            sets += [np.sort(both[: n + rest]), np.sort(np.append(both[:n], both[n + rest :]))]
        begins = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
        sig = neardup.signatures(np.concatenate(sets), begins)
        assert abs((sig[::2] == sig[1::2]).mean() - share) < 0.02


def test_empty_table(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("per_cent", [78, 80, 85, 95, 100])
def test_the_distance_follows_the_threshold(per_cent):
    distance, chunks = neardup.reach(per_cent)
    rng = np.random.default_rng(per_cent)
    differ = (rng.random((2_000_000, neardup.SYMBOLS), np.float32) >= per_cent / 100).sum(axis=1)
    assert (differ > distance).sum() <= 15
    left = rng.integers(0, 1 << 16, (400, neardup.SYMBOLS)).astype(np.uint16)
    right = left.copy()
    for row in right:
        row[rng.choice(neardup.SYMBOLS, distance, replace=False)] += 1
    assert (neardup.index_keys(left, chunks) == neardup.index_keys(right, chunks)).any(axis=1).all()


@pytest.mark.parametrize("per_cent", [0, 50, 77, 101])
def test_thresholds_beyond_the_index_are_errors(spark, per_cent):
    with pytest.raises(ValueError):
        neardup.near_duplicates(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), per_cent=per_cent)
