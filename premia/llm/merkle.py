"""Merkle manifest of a dataset whose parents keep the hash state before each child.

Leaves are digests of records. Within a tree they are numbered by id, every eight consecutive nodes become one parent,
and so on; the tops of all trees become the leaves of one more tree, whose top is the root. A parent is the SHA-256 of
its children's hex digests, and beside it stands the state of that hash before each child slot. When a leaf changes, each
ancestor resumes the state before its slot, takes the new digest and the siblings to the right; those to the left are
never read again.

Texts are hashed where they lie and never shuffled; what is shuffled is 32 bytes a node. Numbers come from ranges of the
sort key and their counts, so that a tree may hold any share of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from premia.llm import sha_states
from premia.llm.common import byte_rows, stored

FAN_OUT = 8
#: Parents handed to Python at once; each carries its children and its path to the root.
_BATCH = 1024
_EMPTY = hashlib.sha256(b"").digest()


def framed(column: Column) -> Column:
    """A value with its length in front, so that different records never give the same bytes; null is ``-``."""
    text = column.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: list[Column]) -> Column:
    """Raw SHA-256 of the framed values."""
    return F.unhex(F.sha2(F.concat(*[framed(c) for c in columns]), 256))


@dataclass
class Manifest:
    """``levels[0]`` holds the runs of leaves, ``levels[k]`` the nodes of height k + 1: ``tree, n`` (nodes one level
    below), ``run, kids`` (slot, digest and, for leaves, ``payload``), ``states`` (32 bytes a slot) and ``digest``.
    ``tops`` is the same for the one tree over the tops of all trees."""

    levels: list[DataFrame]
    tops: list[DataFrame]
    root: bytes


def _ordered(leaves: DataFrame) -> DataFrame:
    """``tree, n, at, digest, payload``: leaves numbered from 0 within their tree by ``key``.

    Equal keys are ordered by digest; a row number splits large groups of equal leaves, whose order does not matter.
    """
    keys = ["tree", "key", "digest", "row"]
    ranges = leaves.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*keys)
    placed = stored(ranges.sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id()).drop("row", "key"), "merkle-leaves")
    part = F.shiftright("place", 33).alias("part")
    counts = placed.groupBy(F.col("tree").alias("t"), part).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    # One row per range and tree: at most as many rows of a tree as there are partitions.
    of_tree = Window.partitionBy("t")
    earlier = F.coalesce(F.sum("rows").over(of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("t", "part", (earlier - F.col("first")).alias("shift"), F.sum("rows").over(of_tree).alias("n"))
    same = F.col("tree").eqNullSafe(F.col("t")) & (F.shiftright("place", 33) == F.col("part"))
    return placed.join(starts, same).select("tree", "n", (F.col("place") + F.col("shift")).alias("at"), "digest", "payload")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the states before each slot and the digest; a lone node is its own digest."""
    for batch in batches:
        kids = batch.column("kids")
        flat = kids.flatten().field("digest")
        digests = sha_states.words(byte_rows(flat)[0])
        bounds = np.frombuffer(kids.buffers()[1], np.int32, len(kids) + 1, kids.offset * 4).astype(np.int64)
        bounds = bounds - bounds[0]
        sizes = np.diff(bounds)
        state = np.tile(sha_states.START, (len(sizes), 1))
        before = np.empty_like(digests)
        for slot in range(FAN_OUT):
            here = np.flatnonzero(sizes > slot)
            child = bounds[here] + slot
            before[child] = state[here]
            state[here] = sha_states.absorb(state[here], sha_states.hex_block(digests[child]))
        out = sha_states.finish(state, sizes)
        lone = np.flatnonzero(batch.column("n").to_numpy() == 1)
        out[lone] = digests[bounds[lone]]
        states = [sha_states.raw_bytes(before[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        digest = [sha_states.raw_bytes(d) for d in out]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(states, pa.binary()), pa.array(digest, pa.binary())], [*batch.schema.names, "states", "digest"])


def _level(nodes: DataFrame, kid: list[str]) -> DataFrame:
    """Parents of nodes numbered by ``at``; a group is at most ``FAN_OUT`` nodes."""
    slot = (F.col("at") % FAN_OUT).cast("int").alias("slot")
    runs = nodes.groupBy("tree", "n", F.floor(F.col("at") / FAN_OUT).alias("run")).agg(F.sort_array(F.collect_list(F.struct(slot, *kid))).alias("kids"))
    schema = StructType(list(runs.schema.fields)).add("states", "binary").add("digest", "binary")
    return stored(runs.mapInArrow(_hashed, schema), "merkle-level", _BATCH)


def _height(column: str = "n") -> Column:
    return F.ceil(F.col(column) / FAN_OUT).cast("long")


def _grown(leaves: DataFrame) -> list[DataFrame]:
    levels = [_level(_ordered(leaves), ["digest", "payload"])]
    while (levels[-1].agg(F.max("n")).first()[0] or 0) > FAN_OUT:
        nodes = levels[-1].filter(F.col("n") > FAN_OUT).select("tree", _height().alias("n"), F.col("run").alias("at"), "digest")
        levels.append(_level(nodes, ["digest"]))
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    found = [level.filter(F.col("n") <= FAN_OUT).select("tree", "digest") for level in levels]
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def build(leaves: DataFrame) -> Manifest:
    """``leaves``: ``tree, key, digest`` and a ``payload`` of any type that stays with the leaf.

    Within a tree leaves ascend by key (nulls first, equal keys by digest); trees ascend likewise. A null tree is a
    tree. Repeated rows are leaves of their own. Without leaves the root is the digest of nothing.
    """
    levels = _grown(leaves.select("tree", "key", "digest", "payload"))
    over = _tops(levels).select(F.lit(0).alias("tree"), F.col("tree").alias("key"), "digest", F.struct(F.col("tree").alias("tree")).alias("payload"))
    tops = _grown(over)
    top = tops[-1].select("digest").first()
    return Manifest(levels, tops, bytes(top[0]) if top else _EMPTY)


def _steps(parents: DataFrame) -> DataFrame:
    """One row per child: its number, its digest and payload, and its step: the state before it and its siblings."""

    def joined(kids: Column) -> Column:
        return F.aggregate(kids, F.lit(b""), lambda a, k: F.concat(a, k["digest"]))

    kid = parents.select("*", F.explode("kids").alias("kid"))
    slot = F.col("kid.slot")
    step = F.struct(
        F.substring("states", slot * 32 + 1, F.lit(32)).alias("state"),
        joined(F.slice("kids", F.lit(1), slot)).alias("left"),
        joined(F.slice("kids", slot + 2, F.lit(FAN_OUT))).alias("right"),
    )
    # A lone leaf is its tree's top and has no step.
    path = F.when(F.col("n") > 1, F.concat(F.array(step), "path")).otherwise(F.col("path"))
    return kid.select("tree", (F.col("run") * FAN_OUT + slot).alias("run"), path.alias("path"), "subroot", "kid")


def _descended(levels: list[DataFrame], of_tree: DataFrame) -> DataFrame:
    """``levels[0]`` with ``path`` (steps from each run to the root) and ``subroot``, given those of the trees."""
    trees = of_tree.withColumnRenamed("tree", "t")
    paths = None
    for level in reversed(levels):
        top = level.filter(F.col("n") <= FAN_OUT)
        here = top.join(trees, F.col("tree").eqNullSafe(F.col("t"))).drop("t")
        if paths is not None:
            given = paths.select(F.col("tree").alias("t"), F.col("run").alias("r"), "path", "subroot")
            same = F.col("tree").eqNullSafe(F.col("t")) & (F.col("run") == F.col("r"))
            here = here.unionByName(level.filter(F.col("n") > FAN_OUT).join(given, same).drop("t", "r"))
        paths = here if level is levels[0] else _steps(here).drop("kid")
    return paths


def _offsets(array: pa.Array) -> np.ndarray:
    found = np.frombuffer(array.buffers()[1], np.int32, len(array) + 1, array.offset * 4).astype(np.int64)
    return found - found[0]


def _resumed(state: np.ndarray, first: np.ndarray, right: np.ndarray, start: np.ndarray, stop: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Parents' digests: from the state before a slot, by its new digest and ``right[start:stop]``."""
    state = sha_states.absorb(state, sha_states.hex_block(first))
    for k in range(FAN_OUT - 1):
        more = np.flatnonzero(start + k < stop)
        if not len(more):
            break
        state[more] = sha_states.absorb(state[more], sha_states.hex_block(right[start[more] + k]))
    return sha_states.finish(state, size)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kids, path = batch.column("kids"), batch.column("path")
        flat, steps = kids.flatten(), path.flatten()
        raw = byte_rows(flat.field("digest"))[0]
        own, bounds = sha_states.words(raw), _offsets(kids)
        sizes = np.diff(bounds)
        run = np.repeat(np.arange(len(sizes)), sizes)
        now = sha_states.words(byte_rows(flat.field("payload").field("changed"))[0])
        before = sha_states.words(byte_rows(batch.column("states"))[0])
        inner = np.flatnonzero(batch.column("n").to_numpy()[run] > 1)
        end = bounds[1:][run]
        now[inner] = _resumed(before[inner], now[inner], own, inner + 1, end[inner], sizes[run[inner]])
        at, left, right = _offsets(path), steps.field("left"), steps.field("right")
        states = sha_states.words(byte_rows(steps.field("state"))[0])
        left_bytes, left_at = byte_rows(left)
        right_bytes, right_at = byte_rows(right)
        siblings, left_at, right_at = sha_states.words(right_bytes), left_at // 32, right_at // 32
        for k in range(int(np.diff(at).max(initial=0))):
            rows = np.flatnonzero(at[run] + k < at[run + 1])
            e = at[run[rows]] + k
            size = np.diff(left_at)[e] + np.diff(right_at)[e] + 1
            now[rows] = _resumed(states[e], now[rows], siblings, right_at[e], right_at[e + 1], size)
        proofs = []
        lefts, rights, hexes = left_bytes.tobytes().hex(), right_bytes.tobytes().hex(), raw.tobytes().hex()
        for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            above = "".join(lefts[64 * left_at[e] : 64 * left_at[e + 1]] + rights[64 * right_at[e] : 64 * right_at[e + 1]] for e in range(at[r], at[r + 1]))
            for i in range(a, b):
                proofs.append(hashlib.sha256((hexes[64 * a : 64 * i] + hexes[64 * (i + 1) : 64 * b] + above).encode()).digest())
        yield pa.RecordBatch.from_arrays(
            [
                flat.field("payload").field("id"),
                flat.field("digest"),
                batch.column("subroot").take(pa.array(run)),
                pa.array(proofs, pa.binary()),
                pa.array([sha_states.raw_bytes(d) for d in now], pa.binary()),
            ],
            ["id", "leaf", "subroot", "proof_sha256", "folded_root"],
        )


def prove(manifest: Manifest) -> DataFrame:
    """One row per leaf: ``id, leaf, subroot, root, proof_sha256`` and the ``folded_root`` that its changed digest
    gives, with ``verified`` telling whether that is the root. The payload of a leaf is ``id`` and ``changed``, its
    digest as found now. ``proof_sha256`` covers the hex digests of all siblings, from the leaf's to the root's."""
    none = F.array().cast("array<struct<state:binary,left:binary,right:binary>>")
    top = manifest.tops[0].select("tree").distinct().withColumns({"path": none, "subroot": F.lit(None).cast("binary")})
    found = _steps(_descended(manifest.tops, top))
    of_tree = stored(found.select(F.col("kid.payload.tree").alias("tree"), "path", F.col("kid.digest").alias("subroot")), "merkle-trees")
    runs = _descended(manifest.levels, of_tree).select("n", "kids", "states", "path", "subroot")
    kind = runs.schema["kids"].dataType.elementType["payload"].dataType["id"].dataType.simpleString()
    schema = f"id {kind}, leaf binary, subroot binary, proof_sha256 binary, folded_root binary"
    out = stored(runs.mapInArrow(_folded, schema), "merkle-proofs", _BATCH)
    root = manifest.root.hex()
    named = out.select("id", *[F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "proof_sha256", "folded_root")])
    return named.withColumns({"root": F.lit(root), "verified": F.col("folded_root") == root})


def manifest_of(docs: DataFrame, fields: list[str], id_col: str, tree_col: str, changed: dict[str, Column] | None = None) -> DataFrame:
    """Build the manifest of ``docs`` and prove each row against it, with the columns of ``changed`` replaced.

    Ids and fields of any type are hashed as text. Nulls, repeated rows and empty tables are handled as ``build`` says;
    other columns are not read.
    """
    now = changed or {}
    leaves = docs.select(
        F.col(tree_col).alias("tree"),
        F.col(id_col).alias("key"),
        leaf_digest([F.col(f) for f in fields]).alias("digest"),
        F.struct(F.col(id_col).alias("id"), leaf_digest([now.get(f, F.col(f)) for f in fields]).alias("changed")).alias("payload"),
    )
    return prove(build(stored(leaves, "merkle-digests")))
