"""Contaminated words against a plain search for every window at every place."""

from __future__ import annotations

import random
import re

import pytest

from premia.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window):
    w = words(text)
    hit, found = set(), set()
    for item, item_text in items:
        iw = words(item_text)
        for s in range(max(1, len(iw) - window + 1)) if iw else ():
            part = iw[s : s + window]
            for p in range(len(w) - len(part) + 1):
                if w[p : p + len(part)] == part:
                    hit.update(range(p, p + len(part)))
                    found |= {str(item)} if item is not None else set()
    return len(w), len(hit), sorted(found)


def test_words_are_those_of_the_pattern():
    text = "".join(map(chr, range(0x250))) + "İKſ x\u0085y 中文🙂a_b-9"
    assert [w.decode() for w in decontaminate.words(text)] == words(text)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_same_as_brute_force(spark, block_bytes):
    rng = random.Random(3)
    vocabulary = ["the", "a", "of", "Été", "zz", "q1", "rare", "中"]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "!"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 4, 5, 9, 15]))) for i in range(25)]
    items += [(25, None), (26, ""), (27, "..."), (None, "null item words here"), (3, "same id twice now"), (12, items[0][1])]
    docs = [(i, text(rng.choice([0, 2, 6, 40, 90])), "x") for i in range(50)]
    docs += [(60, None, "x"), (61, "", "x"), (None, items[1][1], "y"), (60, "null ITEM words here", "z"), (60, "null ITEM words here", "z")]
    out = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string, items string"),
        spark.createDataFrame(items, "item_id long, text string"),
        window=4,
        block_bytes=block_bytes,
    )
    key = lambda x: tuple((v is None, v) for v in x)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in out.collect()), key=key)
    want = sorted(((i, *brute(t, items, 4)) for i, t, _ in docs), key=key)
    assert got == want


def test_long_items_are_cut_without_losing_windows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SEGMENT", 5)
    item = " ".join(f"w{i}" for i in range(40))
    docs = [(s, " ".join(f"w{i}" for i in range(s, s + 4))) for s in range(37)]
    out = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"), window=4
    )
    assert {r.n_hit for r in out.collect()} == {4}


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert decontaminate.contamination(one, none).first().n_hit == 0
    assert decontaminate.contamination(one.limit(0), one.toDF("item_id", "text")).count() == 0


