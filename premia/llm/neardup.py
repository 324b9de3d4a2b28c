"""MinHash near-duplicates by a multi-index Hamming join.

A document is the set of its distinct five-word shingles. Its signature has ``SYMBOLS`` minima of independent hashes,
of which 16 bits each are kept; two signatures differ in a symbol with probability one minus the similarity of the
sets. The distance follows from the link threshold (``reach``): a pair exactly at the threshold differs in more symbols
with a probability of ``MISS`` at most (6e-7 for 25 of the 64 symbols at 85 per cent, 3e-7 for 30 at 80), and more
similar ones less often still.

All pairs of signatures within that distance are found by pigeonhole: the symbols are split into more than half as many
chunks as may differ, so two such signatures differ in at most one symbol of some chunk. Each chunk enters the index
once per symbol that may differ, without that symbol; equal keys meet. The index finds every pair under the distance,
at keys of three or more symbols that hardly ever agree by chance. Thresholds below 78 per cent would need shorter keys
and are an error.

Equal sets are one class and are indexed once. Documents that share a key are not paired all with all: every member is
compared with the smallest one, links join components, and only where members of a key still lie in different
components are these compared, in blocks: first each with its closest one in every other component, then whatever is
left. Before, the shingles that only one of these members has are counted: a pair has at most in common what both share
with anybody, so that most members of a group of heavily edited copies cannot be linked any more. A pair is linked only
after its full shingle sets were compared. No pair within the distance is left out, unless both are already known to be
in one component or that bound rules it out.

Texts that are null, empty or hold no word have the empty set and link with nothing; texts of less than five words have
their whole sequence as the one shingle. Rows without an id link with nothing, get a null component and are kept. Rows
that repeat an id give a row each; equal texts among them are copies like any others. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.common import mixed, run_hashes, slices, stored, text_of, word_runs
from premia.llm.components import components

SHINGLE = 5
SYMBOLS = 64
#: The most a pair at the threshold may be missed with, and the least symbols of a key.
MISS, LEAST_KEY = 1e-6, 3
#: Members of a key that are compared with each other at once.
BLOCK = 256

#: A-Z in lower case; space, tab, line feed, vertical tab, form feed and return end words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 32 or 9 <= b <= 13 else b for b in range(256))
_SEEDS = np.random.Generator(np.random.PCG64(20240501)).integers(0, 1 << 63, (4, SYMBOLS + 1), np.uint64)


def reach(per_cent: int) -> tuple[int, int]:
    """The distance that a pair of this similarity exceeds with a probability of ``MISS`` at most, and the chunks in one
    of which two signatures within it differ in one symbol at most."""
    if not 0 < per_cent <= 100:
        raise ValueError(f"per_cent must be above 0 and at most 100, not {per_cent}")
    differ = 1 - per_cent / 100
    chances = [comb(SYMBOLS, k) * differ**k * (1 - differ) ** (SYMBOLS - k) for k in range(SYMBOLS + 1)]
    distance = next(d for d in range(SYMBOLS + 1) if sum(chances[d + 1 :]) <= MISS)
    chunks = distance // 2 + 1
    if SYMBOLS // chunks - 1 < LEAST_KEY:
        raise ValueError(f"{SYMBOLS} symbols do not cover a similarity of {per_cent} per cent")
    return distance, chunks


#: What the default threshold needs.
DISTANCE, CHUNKS = reach(85)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in a row, and where each text's begin (one more than texts)."""
    folded, starts, stops, rows = word_runs(texts, _FOLD)
    words = run_hashes(folded, starts, stops)
    counts = np.bincount(rows, minlength=len(texts))
    begins = np.concatenate([[0], np.cumsum(counts)])
    factor = np.uint64(0xBF58476D1CE4E5B9)
    hashed, of = [], []
    if len(words) >= SHINGLE:
        joined = np.zeros(len(words) - SHINGLE + 1, np.uint64)
        for k in range(SHINGLE):
            joined = joined * factor + words[k : len(words) - SHINGLE + 1 + k]
        whole = rows[: len(joined)] == rows[SHINGLE - 1 :]
        hashed.append(mixed(joined[whole]))
        of.append(rows[: len(joined)][whole])
    for row in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        joined = np.uint64(counts[row])
        for word in words[begins[row] : begins[row + 1]]:
            joined = np.uint64((int(joined) * int(factor) + int(word)) & 0xFFFFFFFFFFFFFFFF)
        hashed.append(mixed(np.array([joined], np.uint64)))
        of.append(np.array([row]))
    if not hashed:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    values, of = np.concatenate(hashed), np.concatenate(of)
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    new = np.append(True, (values[1:] != values[:-1]) | (of[1:] != of[:-1]))
    values, of = values[new], of[new]
    return values, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(texts)))])


def signatures(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One row of ``SYMBOLS`` 16-bit symbols per set; sets must not be empty."""
    out = np.zeros((len(begins) - 1, SYMBOLS), np.uint16)
    for k in range(SYMBOLS):
        least = np.minimum.reduceat((values ^ _SEEDS[0, k]) * (_SEEDS[1, k] | np.uint64(1)), begins[:-1])
        out[:, k] = (mixed(least) >> np.uint64(48)).astype(np.uint16)
    return out


def digests(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A 128-bit digest of each set that is not empty, as 16 bytes."""
    parts = [np.add.reduceat(mixed((values + _SEEDS[2, i]) * (_SEEDS[3, i] | np.uint64(1))), begins[:-1]) for i in (0, 1)]
    return np.stack(parts, axis=1).astype(">u8").view(np.uint8).reshape(-1, 16)


def index_keys(sigs: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """For each signature one key per chunk and symbol of it that may differ."""
    borders = np.linspace(0, SYMBOLS, chunks + 1).round().astype(int)
    out = np.zeros(sigs.shape, np.uint64)
    wide = (sigs.astype(np.uint64) + np.uint64(1)) * (_SEEDS[2, :SYMBOLS] | np.uint64(1))
    for low, high in zip(borders[:-1], borders[1:], strict=True):
        total = wide[:, low:high].sum(axis=1, dtype=np.uint64)
        for k in range(low, high):
            out[:, k] = mixed((total - wide[:, k]) ^ _SEEDS[3, k])
    return out


def _fixed(rows: np.ndarray) -> pa.Array:
    """A binary array of equally long rows."""
    flat = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1)
    offsets = (np.arange(len(rows) + 1) * flat.shape[1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(flat.tobytes())])


def _unfixed(array: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(array.to_pylist()), kind).reshape(len(array), width)


def _sets(docs: DataFrame) -> DataFrame:
    """``id``, ``n_shingles``, ``class`` (digest of the set; null if it is empty) and ``sig`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, begins = shingle_sets(part.column(1))
                n = np.diff(begins)
                full = n > 0
                lone, sig = np.zeros((len(n), 16), np.uint8), np.zeros((len(n), SYMBOLS), np.uint16)
                if full.any():
                    inner = np.append(begins[:-1][full], begins[-1])
                    lone[full], sig[full] = digests(values, inner), signatures(values, inner)
                classes = pc.if_else(pa.array(full), _fixed(lone), pa.scalar(None, pa.binary()))
                sigs = pc.if_else(pa.array(full), _fixed(sig), pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), classes, sigs], names=["id", "n_shingles", "class", "sig"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {kind}, n_shingles long, class binary, sig binary")


def _keys(classes: DataFrame, chunks: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                keys = index_keys(_unfixed(part.column(1), np.uint16, SYMBOLS), chunks)
                who = part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), SYMBOLS)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), who], names=["key", "class"])

    return classes.select("class", "sig").mapInArrow(run, "key long, class binary")


def _close(pairs: DataFrame, classes: DataFrame, per_cent: int, distance: int) -> DataFrame:
    """Candidate pairs whose signatures are within the distance and whose sizes allow a link."""
    side = lambda x: classes.select(F.col("class").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(100 * F.least("n_a", "n_b") >= per_cent * F.greatest("n_a", "n_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_unfixed(batch.column(k), np.uint16, SYMBOLS) for k in (2, 3))
            near = pa.array((left != right).sum(axis=1) <= distance)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], names=["a", "b"])

    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a binary, b binary")


def _full_sets(texts: DataFrame) -> DataFrame:
    """``class``, ``set`` (its shingle hashes in order) and ``tops`` (their upper halves); ``texts`` has ``class`` and
    ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, begins = shingle_sets(part.column(1))
                rows, tops = [], []
                for i, wanted in enumerate(part.column(0).to_pylist()):
                    own = values[begins[i] : begins[i + 1]]
                    # A row may share the id of the wanted one and hold another text.
                    same = len(own) > 0 and digests(own, np.array([0, len(own)]))[0].tobytes() == wanted
                    rows.append(own.tobytes() if same else None)
                    tops.append((own >> np.uint64(32)).astype(np.uint32).tobytes())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.binary()), pa.array(tops, pa.binary())], names=["class", "set", "tops"])

    found = texts.select("class", "text").mapInArrow(run, "class binary, set binary, tops binary")
    return found.filter(F.col("set").isNotNull()).dropDuplicates(["class"])


def _confirmed(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Pairs whose full shingle sets are similar enough."""
    side = lambda x: sets.select(F.col("class").alias(x), F.col("set").alias(f"set_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                place = np.searchsorted(x, y)
                common = int((x[np.minimum(place, len(x) - 1)] == y).sum())
                linked.append(100 * common >= per_cent * (len(x) + len(y) - common))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(run, "a binary, b binary")


def _open_members(members: DataFrame, found: DataFrame) -> DataFrame:
    """``key``, ``class``, ``component`` and the key's number of members ``n``, of keys with more than one component."""
    labels = found.withColumnRenamed("node", "class")
    placed = members.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    spread = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    return placed.join(spread.filter((F.col("low") != F.col("high")) & (F.col("n") > 2)).select("key", "n"), "key")


def _shared_sizes(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """``class`` and ``own``: how many of its shingles no other of these classes has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "set"):
                rows = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(1)]
                who = part.column(0).take(pa.array(np.repeat(np.arange(len(rows)), [len(x) for x in rows])))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rows)), who], names=["shingle", "class"])

    each = sets.join(classes, "class", "left_semi").select("class", "set").mapInArrow(run, "shingle long, class binary")
    lone = each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("class").alias("class")).filter("n = 1")
    return lone.groupBy("class").agg(F.count("*").alias("own"))


def _open_blocks(rows: DataFrame, classes: DataFrame, own: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Members that can still be linked, by key and in blocks."""
    known = classes.select("class", "sig", "n_shingles").join(own, "class").withColumn("shared", F.col("n_shingles") - F.col("own"))
    known = known.filter(100 * F.col("shared") >= per_cent * F.col("n_shingles")).join(sets.select("class", "tops"), "class")
    able = rows.join(known, "class")
    numbered = able.withColumn("block", F.pmod(F.xxhash64("class"), F.ceil(F.col("n") / BLOCK)))
    member = F.struct("class", "component", "sig", "n_shingles", "shared", "tops")
    blocks = numbered.groupBy("key", "block").agg(F.collect_list(member).alias("held"))
    lively = blocks.groupBy("key").agg(F.sum(F.size("held")).alias("n")).filter("n > 1").select("key")
    return blocks.join(lively, "key")


def _block_pairs(blocks: DataFrame, per_cent: int, closest: bool, distance: int, chunks: int) -> DataFrame:
    """Pairs of different components within the distance, of all pairs of blocks of a key; with ``closest`` only the
    nearest one of every other component for each member.

    What two members have in common is at most what each shares with anybody, and at most as many shingle hashes as
    agree in their upper halves; both bound their similarity. A pair that meets at several keys is given at the first of
    them alone.
    """
    other = blocks.select("key", F.col("block").alias("block_b"), F.col("held").alias("held_b"))
    both = blocks.join(other, "key").filter(F.col("block") <= F.col("block_b")).select("key", "held", "held_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: set[tuple[bytes, bytes]] = set()
            for key, left, right in zip(batch.column(0).to_numpy().view(np.uint64), batch.column(1), batch.column(2), strict=True):
                x, y = ({k: side.values.field(i) for i, k in enumerate(("class", "component", "sig", "n", "shared", "tops"))} for side in (left, right))
                names = {c: i for i, c in enumerate(dict.fromkeys([*x["component"].to_pylist(), *y["component"].to_pylist()]))}
                cx, cy = (np.array([names[c] for c in z["component"].to_pylist()]) for z in (x, y))
                if len(names) == 1:
                    continue
                sx, sy = (_unfixed(z["sig"], np.uint16, SYMBOLS) for z in (x, y))
                (nx, mx), (ny, my) = ([z[c].to_numpy(zero_copy_only=False).astype(float) for c in ("n", "shared")] for z in (x, y))
                most = np.minimum(mx[:, None], my[None])
                i, j = np.nonzero((100 * most >= per_cent * (nx[:, None] + ny[None] - most)) & (cx[:, None] != cy[None]))
                differ = (sx[i] != sy[j]).sum(axis=1)
                near = differ <= distance
                i, j, differ = i[near], j[near], differ[near]
                if len(i):
                    kx, ky = index_keys(sx, chunks), index_keys(sy, chunks)
                    first = np.argmax(kx[i] == ky[j], axis=1)
                    here = kx[i, first] == key
                    i, j, differ = i[here], j[here], differ[here]
                    tx, ty = ([np.frombuffer(t.as_buffer(), np.uint32) for t in z["tops"]] for z in (x, y))
                    common = np.array([(tx[p][np.minimum(np.searchsorted(tx[p], ty[q]), len(tx[p]) - 1)] == ty[q]).sum() for p, q in zip(i, j, strict=True)], float)
                    may = 100 * common >= per_cent * (nx[i] + ny[j] - common)
                    i, j, differ = i[may], j[may], differ[may]
                if closest and len(i):
                    order = np.lexsort((differ, cy[j], i))
                    i, j = i[order], j[order]
                    ahead = np.append(True, (i[1:] != i[:-1]) | (cy[j[1:]] != cy[j[:-1]]))
                    i, j = i[ahead], j[ahead]
                a, b = x["class"].to_pylist(), y["class"].to_pylist()
                out.update((min(a[p], b[q]), max(a[p], b[q])) for p, q in zip(i, j, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return both.mapInArrow(run, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_cent: int = 85) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` (the id), ``n_shingles``, ``component_id`` (smallest id reachable over
    links, itself included) and ``kept`` (whether that is the row itself). ``per_cent`` is 78 or more, see ``reach``."""
    distance, chunks = reach(per_cent)
    given = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = stored(_sets(given), "neardup-sets")
    linkable = rows.filter(F.col("class").isNotNull() & F.col("id").isNotNull())
    first = F.min(F.struct("id", "n_shingles", "sig")).alias("first")
    classes = stored(linkable.groupBy("class").agg(first).select("class", "first.*"), "neardup-classes")
    keys = _keys(classes, chunks)
    shared = keys.groupBy("key").agg(F.min("class").alias("pivot"), F.count("*").alias("n")).filter("n > 1").select("key", "pivot")
    members = stored(keys.join(shared, "key"), "neardup-members")
    involved = stored(members.select("class").distinct().join(classes.select("class", "id"), "class"), "neardup-involved")
    sets = stored(_full_sets(given.join(involved, "id")), "neardup-full")

    stars = members.filter(F.col("pivot") != F.col("class")).select(F.col("pivot").alias("a"), F.col("class").alias("b")).distinct()
    links = stored(_confirmed(stored(_close(stars, classes, per_cent, distance), "neardup-pairs"), sets, per_cent), "neardup-links")
    found = components(links)
    for closest in (True, False):
        still = stored(_open_members(members.select("key", "class"), found), "neardup-open")
        own = _shared_sizes(still.select("class").distinct(), sets)
        known = still.select("class").distinct().join(own, "class", "left").select("class", F.coalesce("own", F.lit(0)).alias("own"))
        blocks = stored(_open_blocks(still, classes, known, sets, per_cent), "neardup-blocks")
        if blocks.isEmpty():
            break
        more = stored(_confirmed(stored(_block_pairs(blocks, per_cent, closest, distance, chunks), "neardup-pairs", batch_rows=32), sets, per_cent), "neardup-links")
        if not more.isEmpty():
            links = links.unionByName(more)
            found = components(links)

    labels = found.withColumnRenamed("node", "class").join(classes.select("class", "id"), "class")
    least = labels.groupBy("component").agg(F.min("id").alias("least"))
    joined = labels.join(least, "component").select("class", "least")
    own = classes.select("class", "id").join(joined, "class", "left").select("class", F.coalesce("least", "id").alias("component_id"))
    alone = F.col("class").isNull() | F.col("id").isNull()
    out = rows.select("id", "n_shingles", "class").join(own, "class", "left")
    out = out.withColumn("component_id", F.when(alone, F.col("id")).otherwise(F.col("component_id")))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))

