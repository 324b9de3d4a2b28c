"""Merkle manifest against plain lists and hashlib."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from premia.llm import merkle, sha_states

FIELDS = ["doc_id", "lang", "text"]
SCHEMA = "doc_id long, lang string, text string, tree string, kids string, n int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def grown(leaves):
    """All levels of one tree, from its leaves to its top."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def climbed(levels, at, changed):
    """Joined siblings on the way up, and the top that a changed leaf gives."""
    proof = ""
    for level in levels[:-1]:
        low = at // 8 * 8
        run = level[low : low + 8]
        proof += "".join(run[: at - low] + run[at - low + 1 :])
        run[at - low] = changed
        changed, at = sha("".join(run)), at // 8
    return proof, changed


def brute(rows, change):
    def bytewise(v):
        return (v is not None, v.encode() if isinstance(v, str) else v)

    trees = defaultdict(list)
    for doc_id, lang, text, *_ in rows:
        leaf = sha("".join(map(framed, (doc_id, lang, text))))
        other = sha("".join(map(framed, (doc_id, lang, change(doc_id, text)))))
        trees[lang].append((doc_id is not None, doc_id or 0, leaf, other))
    langs = sorted(trees, key=bytewise)
    levels = {lang: grown([x[2] for x in sorted(trees[lang])]) for lang in langs}
    tops = grown([levels[lang][-1][0] for lang in langs])
    root, out = tops[-1][0], []
    for t, lang in enumerate(langs):
        for at, (known, doc_id, leaf, other) in enumerate(sorted(trees[lang])):
            proof, top = climbed(levels[lang], at, other)
            above, folded = climbed(tops, t, top)
            out.append((doc_id if known else None, leaf, levels[lang][-1][0], root, sha(proof + above), folded, folded == root))
    return out


def proved(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    text = F.when(F.col("doc_id") % 3 == 0, F.upper("text")).otherwise(F.col("text"))
    found = merkle.manifest_of(docs, FIELDS, "doc_id", "lang", {"text": text})
    return [tuple(r) for r in found.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


def upper_third(doc_id, text):
    return text.upper() if text is not None and doc_id is not None and doc_id % 3 == 0 else text


def test_same_as_lists(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["en"] * 9 + ["de"]), rng.choice(["", "a", "É é", "x" * 200, None]), "t", "k", 1) for i in range(700)]
    rows += [(1000 + i, f"l{i:02d}", "lone", "t", "k", 1) for i in range(20)]  # more languages than one run
    rows += [(2000 + i, None, f"no language {i}", "t", "k", 1) for i in range(9)] + [(3000 + i, "eight", "b", None, None, None) for i in range(8)]
    rows += [(None, "en", "no id", "t", "k", 1)] * 3 + [rows[5]] * 4 + [(rows[5][0], rows[5][1], "same id, other text", "t", "k", 1)]
    rng.shuffle(rows)
    got, want = proved(spark, rows), brute(rows, upper_third)
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65])
def test_one_language(spark, n):
    rows = [(i, "en", f"Text {i}", "t", "k", 1) for i in range(1, n + 1)]
    assert sorted(proved(spark, rows), key=str) == sorted(brute(rows, upper_third), key=str)


def test_ids_and_trees_of_other_types_long_text_and_empty_table(spark):
    docs = spark.createDataFrame([("b", 2, "x" * 3_000_000), ("a", 2, "y"), ("c", 1, None)], "doc_id string, lang int, text string")
    found = {r.id: r for r in merkle.manifest_of(docs, FIELDS, "doc_id", "lang").collect()}
    a, b, c = (sha("".join(map(framed, r))) for r in (("a", 2, "y"), ("b", 2, "x" * 3_000_000), ("c", 1, None)))
    assert all(r.verified for r in found.values())
    assert found["a"].root == sha(c + sha(a + b)) and found["a"].proof_sha256 == sha(b + c) and found["c"].subroot == c
    assert proved(spark, []) == []


def test_parents_keep_the_state_before_each_child(spark):
    docs = spark.createDataFrame([(i, "en", f"t{i}", "", "", 0) for i in range(20)], SCHEMA)
    leaves = docs.select(
        F.col("lang").alias("tree"),
        F.col("doc_id").alias("key"),
        merkle.leaf_digest([F.col("text")]).alias("digest"),
        F.struct(F.col("doc_id").alias("id"), merkle.leaf_digest([F.lit("new")]).alias("changed")).alias("payload"),
    )
    manifest = merkle.build(leaves)
    assert [level.count() for level in manifest.levels] == [3, 1]
    for row in manifest.levels[0].collect():
        states = sha_states.words(bytes(row.states))
        assert (states[0] == sha_states.START).all() and len(states) == len(row.kids)
        for slot, kid in enumerate(row.kids):
            # Resuming the state before a slot with what follows gives the parent.
            rest = sha_states.words(b"".join(bytes(k.digest) for k in row.kids[slot:]))
            state = states[slot : slot + 1]
            for digest in rest:
                state = sha_states.absorb(state, sha_states.hex_block(digest[None]))
            assert sha_states.raw_bytes(sha_states.finish(state, np.array([len(row.kids)]))) == bytes(row.digest)
            assert kid.slot == slot


def test_states_agree_with_hashlib():
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(40)]
    for n in (1, 2, 8, 40):
        state = sha_states.START[None].copy()
        for d in digests[:n]:
            state = sha_states.absorb(state, sha_states.hex_block(sha_states.words(d)))
        want = hashlib.sha256("".join(d.hex() for d in digests[:n]).encode()).digest()
        assert sha_states.raw_bytes(sha_states.finish(state, np.array([n]))) == want
