"""The corpus pipeline on a small table whose every document has a known fate."""

from __future__ import annotations

import random
import re

import public_tokenizers
import pytest

import corpus_pipeline
from premia.llm import bpe

BAD = ["idiot", "scum", "moron"]


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "rho", "tau", "phi"]) + str(rng.randrange(400)) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    rows, labels, fate = [], [], {}
    for i in range(300):
        words = prose(rng, rng.choice([20, 60, 120])).split()
        toxic = i % 4 == 0
        if toxic:
            words = [w for x in words for w in ((x, rng.choice(BAD)) if rng.random() < 0.2 else (x,))] + BAD
        rows.append((i, " ".join(words)))
        fate[i] = "toxic" if toxic else "stays"
        labels.append((i, 1, int(toxic)))
    base, item = prose(rng, 150), prose(rng, 30)
    rows += [(1000, base), (1001, base + " more"), (1002, base), (1002, base), (1003, item), (1004, prose(rng, 300) + " " + item + " " + prose(rng, 300))]
    fate |= {1000: "stays", 1001: "copy", 1002: "copy", 1003: "contaminated", 1004: "stays"}
    rows += [(1005, f"{prose(rng, 20)} password=abcdef123456XYZ end"), (1006, None), (1007, ""), (None, prose(rng, 25)), (None, None)]
    fate |= {1005: "masked", 1006: "stays", 1007: "stays"}
    # Rows of one id with different texts are documents of their own: the near copy among them goes, the other stays.
    double, other = prose(rng, 80), prose(rng, 80)
    rows += [(1010, double), (1011, other), (1011, double + " more")]
    fate |= {1010: "stays", 1011: "stays"}
    # Two rows of one id and text: one of them stays.
    rows += [(1008, prose(rng, 40))] * 2
    fate[1008] = "stays"
    path = tmp_path_factory.mktemp("corpus")
    full = [(i, t, "en", f"src{k % 5}" if k % 7 else None, None if t is None else len(t), "x", 1, "y") for k, (i, t) in enumerate(rows)]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, toxicity string, spans int, `a.b` string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(7, item), (8, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, fate


@pytest.fixture(scope="module")
def steps(spark, folder, tmp_path_factory):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    out = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("steps") / name)
        stage(spark, docs, folder[0]).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def test_columns_are_those_of_the_documents(steps):
    for name in ("toxicity", "near_duplicates", "decontamination", "secrets"):
        assert steps[name].dtypes == steps[""].dtypes


def test_toxic_documents_go(steps, folder):
    fate = folder[2]
    left = set(ids(steps["toxicity"]))
    assert not any(f == "toxic" for i, f in fate.items() if i in left and i % 5)
    assert {i for i, f in fate.items() if f != "toxic"} <= left and None in left


def test_one_of_each_group_stays(steps, folder):
    before, after = steps["toxicity"], steps["near_duplicates"]
    gone = {i for i, f in folder[2].items() if f == "copy"}
    assert sorted(ids(after), key=str) == sorted([*(set(ids(before)) - gone - {None}), None, None], key=str)
    rows = {r.doc_id: r for r in before.collect() if r.doc_id is not None}
    assert all(r == rows[r.doc_id] for r in after.collect() if r.doc_id not in (None, 1008, 1011))
    texts = lambda df: [r.text for r in df.collect() if r.doc_id == 1011]
    assert len(texts(before)) == 2 and len(texts(after)) == 1 and not texts(after)[0].endswith(" more")


def test_contaminated_documents_go(steps):
    assert set(ids(steps["near_duplicates"])) - set(ids(steps["decontamination"])) == {1003}


def test_secrets_are_masked_and_the_rest_is_unchanged(steps):
    before = {r.doc_id: r for r in steps["decontamination"].collect() if r.doc_id is not None}
    for r in steps["secrets"].collect():
        if r.doc_id == 1005:
            assert r.text == re.sub(r"password=\S+", "[removed]", before[1005].text) and r.n_chars == len(r.text)
        elif r.doc_id is not None:
            assert r == before[r.doc_id]


def test_tokens_round_trip(steps):
    enc = bpe.encoding(corpus_pipeline.RANKS, public_tokenizers.PATTERN)
    texts = sorted((r.text or "" for r in steps["secrets"].collect()))
    assert sorted(enc.decode(r.ids) for r in steps["tokens"].collect()) == texts


def test_run_gives_the_last_stage(spark, folder, steps):
    key = lambda df: sorted((str(r.doc_id), list(r.ids)) for r in df.collect())
    assert key(corpus_pipeline.run(spark, folder[0])) == key(steps["tokens"])


def test_empty_tables(spark, tmp_path, folder):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_from_four_fifths_on_go(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(204)]

    def copy(shared):
        """A document with this share of its shingles in common with the words."""
        n = round(200 * shared)
        return " ".join(words[: n + 4] + [f"x{rng.randrange(10**9)}" for _ in range(200 - n)])

    rows = [(1, " ".join(words)), (2, copy(0.9)), (3, prose(rng, 80))]
    # 180 of 220 shingles in common are 0.82; 174 of 226 are 0.77.
    others = [(4, copy(0.87))]
    left = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(ids(left)) == [1, 3]
    left = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows[:1] + others, "doc_id long, text string"), "")
    assert sorted(ids(left)) == [1, 4]
