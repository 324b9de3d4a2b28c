"""Digests of files against hashlib."""

from __future__ import annotations

import hashlib

import pytest

from premia.sources import digests


def tree_of(data: bytes, block: int, fanout: int) -> str:
    nodes = [hashlib.sha256(data[i : i + block]).hexdigest() for i in range(0, max(len(data), 1), block)]
    while len(nodes) > 1:
        nodes = [hashlib.sha256("".join(nodes[i : i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]
    return nodes[0]


@pytest.fixture
def folder(tmp_path):
    files = {"empty.bin": b"", "one.bin": b"x", "even.bin": bytes(range(256)) * 4, "odd name #1.bin": b"ab" * 701 + b"c", "long.bin": b"\r\n" * 4001}
    (tmp_path / "inner").mkdir()
    for i, (name, data) in enumerate(files.items()):
        (tmp_path / ("inner" if i % 2 else "") / name).write_bytes(data)
    # Spark's listing leaves out empty files.
    return str(tmp_path), {n: d for n, d in files.items() if d}


def test_file_digests_are_plain_sha256_on_both_ways(spark, folder):
    path, files = folder
    want = {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in files.items()}
    for whole in (digests.WHOLE, 1000, -1):
        found = digests.file_digests(spark, path, block=64, whole=whole).collect()
        assert {r["file"]: (r["bytes"], r["file_sha256"]) for r in found} == want and len(found) == len(files)


@pytest.mark.parametrize(("block", "fanout"), [(1024, 2), (100, 3), (7, 2), (7, 1024), (8 << 20, 1024)])
def test_tree_digests_equal_brute_force(spark, folder, block, fanout):
    path, files = folder
    found = {r["file"]: (r["bytes"], r["n_blocks"], r["tree_sha256"]) for r in digests.tree_digests(spark, path, block, fanout).collect()}
    assert found == {n: (len(d), max(1, -(-len(d) // block)), tree_of(d, block, fanout)) for n, d in files.items()}


def test_a_file_beyond_the_size_of_an_array_has_both_digests(spark, tmp_path):
    size = 3 * 1024**3 + 5
    with open(tmp_path / "sparse.bin", "wb") as out:
        out.truncate(size)
    zero, plain = bytes(digests.BLOCK), hashlib.sha256()
    for start in range(0, size, digests.BLOCK):
        plain.update(zero[: size - start])
    block, rest = hashlib.sha256(zero).hexdigest(), hashlib.sha256(bytes(5)).hexdigest()
    row = digests.file_digests(spark, str(tmp_path)).first()
    assert (row["bytes"], row["file_sha256"]) == (size, plain.hexdigest())
    row = digests.tree_digests(spark, str(tmp_path)).first()
    assert (row["n_blocks"], row["tree_sha256"]) == (385, hashlib.sha256((block * 384 + rest).encode()).hexdigest())


def test_a_folder_without_files_gives_no_rows(spark, tmp_path):
    assert digests.file_digests(spark, str(tmp_path)).count() == 0
    assert digests.tree_digests(spark, str(tmp_path)).count() == 0


def test_impossible_trees_are_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        digests.tree_digests(spark, str(tmp_path), fanout=1)
