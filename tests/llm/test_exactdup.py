"""Exact duplicates against grouping by the whole normalised text."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from premia.llm import exactdup

SCHEMA = "doc_id long, text string, name string, rows string, digest string"


def brute(rows):
    groups = defaultdict(list)
    for place, (doc_id, text, *_) in enumerate(rows):
        groups[re.sub("[ \t-\r]+", " ", text or "")].append((doc_id is None, doc_id or 0, place))
    out = []
    for text, members in groups.items():
        first = min(members)
        for unknown, doc_id, place in members:
            out.append(
                (
                    None if unknown else doc_id,
                    None if first[0] else first[1],
                    len(members),
                    place == first[2],
                    hashlib.sha256(text.encode()).hexdigest(),
                )
            )
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = [
        "".join(rng.choices(["ab", "é", "🙂", " ", "\t\n", "x", " ", "\u0085"], k=rng.choice([0, 1, 4, 20, 90]))) for _ in range(60)
    ]
    out = [(i, rng.choice(texts), "x", "y", "z") for i in range(300)]
    out += [(i, "hot group " * 9, "x", None, "z") for i in range(300, 450)]
    out += [(500, None, "x", "y", "z"), (501, "", "x", "y", "z"), (None, "", "x", "y", "z"), (502, " ", None, "y", "z")]
    out += [(None, "no id", "x", "y", "z")] * 2 + [(600, "twice", "x", "y", "z")] * 2 + [(601, "twice", "x", "y", "z")]
    # Same blocks in another order, one block more, one block less, a block repeated.
    a, b, c = "a" * 16, "b" * 16, "c" * 16
    mixed = [a + b, b + a, a + b + a, a + b + a + b, a + b + c, c, a + b + c + c, a + b + c + c + a, a * 8, a * 9, a * 16]
    out += [(700 + i, t, "x", "y", "z") for i, t in enumerate(mixed + mixed)]
    return out


@pytest.mark.parametrize("block_bytes", [16, exactdup.BLOCK_BYTES])
def test_same_as_grouping_by_text(spark, rows, block_bytes):
    docs = spark.createDataFrame(rows, SCHEMA)
    out = exactdup.exact_duplicates(docs, block_bytes=block_bytes).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(str, (tuple(r) for r in out))) == sorted(map(str, brute(rows)))


def test_very_long_text_that_differs_in_its_last_byte(spark):
    long = "word " * 400_000
    docs = spark.createDataFrame([(1, long + "a"), (2, long + "b"), (3, long + "a")], "doc_id int, text string")
    out = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exactdup.exact_duplicates(docs).collect()}
    assert out == {1: (1, 2, True), 2: (2, 1, True), 3: (1, 2, False)}


def test_a_digest_of_two_blocks_is_found_and_replaced(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, SCHEMA)
    weak = lambda block: F.substring(F.md5(block), 1, 2)
    monkeypatch.setattr(exactdup, "DIGESTS", (weak, F.md5))
    out = exactdup.exact_duplicates(docs, block_bytes=16).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(str, (tuple(r) for r in out))) == sorted(map(str, brute(rows)))
    monkeypatch.setattr(exactdup, "DIGESTS", (weak,))
    with pytest.raises(ValueError, match="share every digest"):
        exactdup.identities(docs, block_bytes=16)


def test_text_ids_and_empty_table(spark):
    docs = spark.createDataFrame([("b", "x  y"), ("a", "x y")], "doc_id string, text string")
    out = {r.doc_id: (r.keep_id, r.kept) for r in exactdup.exact_duplicates(docs).collect()}
    assert out == {"a": ("a", True), "b": ("a", False)}
    assert exactdup.exact_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_is_native(spark, rows):
    plan = exactdup.exact_duplicates(spark.createDataFrame(rows, SCHEMA))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
