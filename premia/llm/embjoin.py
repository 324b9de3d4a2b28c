"""Embedding near-duplicates by an epsilon grid order join.

Two unit vectors with a cosine of at least ``least`` lie at most ``sqrt(2 - 2 * least)`` apart, in every orthonormal
projection too. Vectors are projected on the leading principal axes of the whole table and sorted by label, length and
the cells of a grid of that width; the sorted sequence is cut into blocks. Intervals of the sequence are joined
recursively, from large ones down to blocks: a pair of intervals whose bounding cells are more than one cell apart on
any axis cannot hold a link and is dropped with everything below it. Only pairs of blocks that remain are compared, by
one product of matrices in double precision each.

Equal vectors of a label are one class with a count. A pair of blocks gives one row per member with a link: how many
vectors it is linked with there, and a representative of its component among the two blocks. So the output of a dense
group grows with its members and blocks, not with its pairs, and connected components need no other links.

Vectors that are null, empty, zero or hold null or non-finite components, and rows without a label or id, link with
nothing. Vectors of different length are never compared. Rows that repeat an id give a row each and count as vectors of
their own. Extra columns are ignored. The principal axes only decide what can be skipped; any axes give the same links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.common import stored
from premia.llm.components import components

#: Leading principal axes that the order and the bounding cells use.
AXES = 6
#: Vectors of a block, and children of an interval on each level above.
BLOCK, FANOUT = 256, 32


def _vectors(given: DataFrame) -> DataFrame:
    """``id``, ``class`` (null if the row cannot be linked), ``label``, ``size`` and the vector as doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usable = [i.is_valid and label.is_valid for i, label in zip(batch.column(0), batch.column(1), strict=True)]
            classes: list[bytes | None] = []
            sizes: list[int | None] = []
            raws: list[bytes | None] = []
            for ok, label, vector in zip(usable, batch.column(1), batch.column(2), strict=True):
                raw = None
                if ok and vector.is_valid and len(vector) and not vector.values.null_count:
                    x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    largest = float(np.abs(x).max())
                    if 0 < largest < math.inf:
                        # A power of two changes no cosine; without it, squares of such components over- or underflow.
                        scaled = x if 1e-100 < largest < 1e100 else np.ldexp(x, -math.frexp(largest)[1])
                        raw = (scaled + 0.0).tobytes()
                raws.append(raw)
                sizes.append(len(raw) // 8 if raw else None)
                classes.append(blake2b(raw, digest_size=16, key=blake2b(f"{label.type} {label.as_py()}".encode()).digest()).digest() if raw else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(classes, pa.binary()), batch.column(1), pa.array(sizes, pa.int64()), pa.array(raws, pa.binary())],
                names=["id", "class", "label", "size", "raw"],
            )

    kinds = {c: given.schema[c].dataType.simpleString() for c in ("id", "label")}
    return given.mapInArrow(run, f"id {kinds['id']}, class binary, label {kinds['label']}, size long, raw binary")


def _matrix(raws: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of equal length and their norms."""
    x = np.frombuffer(b"".join(raws.to_pylist()), np.float64).reshape(len(raws), -1)
    return x, np.sqrt(np.einsum("ij,ij->i", x, x))


def principal_axes(classes: DataFrame, axes: int = AXES) -> dict[int, np.ndarray]:
    """For each vector length the leading principal axes of its unit vectors, from sums over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            size = batch.column(0).to_numpy()
            for d in np.unique(size):
                x, norm = _matrix(batch.column(1).filter(pa.array(size == d)))
                x = np.hstack([x / norm[:, None], np.ones((len(x), 1))])
                sums[int(d)] = sums.get(int(d), 0) + x.T @ x
        for d, total in sums.items():
            places = np.arange((d + 1) ** 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(places), d)), pa.array(places), pa.array(total.ravel())], names=["size", "place", "total"])

    rows = classes.select("size", "raw").mapInArrow(run, "size long, place long, total double").groupBy("size", "place").agg(F.sum("total").alias("total")).collect()
    found: dict[int, np.ndarray] = {}
    for r in rows:
        found.setdefault(r["size"], np.zeros((r["size"] + 1) ** 2))[r["place"]] = r["total"]
    out = {}
    for d, flat in found.items():
        total = flat.reshape(d + 1, d + 1)
        mean = total[-1, :-1] / total[-1, -1]
        values, vectors = np.linalg.eigh(total[:-1, :-1] / total[-1, -1] - np.outer(mean, mean))
        out[d] = vectors[:, np.argsort(values)[::-1][:axes]]
    return out


def _ordered_blocks(classes: DataFrame, axes: dict[int, np.ndarray], width: float) -> DataFrame:
    """The sequence in grid order, cut into blocks with their bounding cells; ``part`` and ``place`` give its order."""
    kind = classes.schema["label"].dataType.simpleString()
    cells = [f"c{k}" for k in range(AXES)]

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(2).to_numpy()
            at = np.zeros((batch.num_rows, AXES), np.int64)
            for d in np.unique(size):
                x, norm = _matrix(batch.column(3).filter(pa.array(size == d)))
                cell = np.floor((x / norm[:, None]) @ axes[int(d)] / width).astype(np.int64)
                at[size == d, : cell.shape[1]] = cell
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(at[:, k]) for k in range(AXES)]], names=["class", "label", "size", "raw", "n", *cells])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        place, held = 0, None

        def block(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            bounds = [pa.array([f(rows.column(c).to_numpy())], pa.int64()) for c in cells for f in (np.min, np.max)]
            members = b"".join(rows.column("class").to_pylist())
            raw = b"".join(rows.column("raw").to_pylist())
            counts = rows.column("n").to_numpy().astype(np.int64).tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([place], pa.int64()), rows.column("label").slice(0, 1).combine_chunks(), rows.column("size").slice(0, 1).combine_chunks(), *bounds]
                + [pa.array([x], pa.binary()) for x in (members, raw, counts)],
                schema=out_schema,
            )

        out_schema = None
        for batch in batches:
            if out_schema is None:
                bounds = [(f"{s}_{c}", pa.int64()) for c in cells for s in ("lo", "hi")]
                out_schema = pa.schema([("part", pa.int64()), ("place", pa.int64()), ("label", batch.schema.field("label").type), ("size", pa.int64()), *bounds, ("members", pa.binary()), ("raw", pa.binary()), ("counts", pa.binary())])
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            label, size = held.column("label").to_numpy(), held.column("size").to_numpy()
            borders = np.flatnonzero((label[1:] != label[:-1]) | (size[1:] != size[:-1])) + 1
            start = 0
            for end in [*borders.tolist(), None]:
                while (end or len(label)) - start >= (1 if end else BLOCK):
                    stop = min(start + BLOCK, end or len(label))
                    yield block(held.slice(start, stop - start))
                    place, start = place + 1, stop
            held = held.slice(start)
        if held is not None and held.num_rows:
            yield block(held)

    located = classes.select("class", "label", "size", "raw", "n").mapInArrow(locate, f"class binary, label {kind}, size long, raw binary, n long, " + ", ".join(f"{c} long" for c in cells))
    order = ["label", "size", *cells, "class"]
    sequence = located.repartitionByRange(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    bounds = ", ".join(f"lo_{c} long, hi_{c} long" for c in cells)
    return sequence.mapInArrow(cut, f"part long, place long, label {kind}, size long, {bounds}, members binary, raw binary, counts binary")


def _boxes(blocks: DataFrame) -> list[DataFrame]:
    """Bounding boxes of the sequence's intervals by level, blocks first; each row names its parent interval."""
    spans = [f"c{k}" for k in range(AXES)]
    row = blocks.select(
        F.struct("part", "place").alias("node"),
        F.struct("part", (F.col("place") / FANOUT).cast("long").alias("place")).alias("parent"),
        *[F.col(x).alias(f"{s}_{x}") for x in ("label", "size") for s in ("lo", "hi")],
        *[f"{s}_{c}" for c in spans for s in ("lo", "hi")],
    )
    levels = [stored(row, "ego-level")]
    most, places = levels[0].agg(F.max("node.part"), F.max("node.place")).first()
    names = [f"{s}_{c}" for c in ["label", "size", *spans] for s in ("lo", "hi")]
    while (most or 0) > 0 or (places or 0) > 0:
        inner = (places or 0) >= FANOUT
        places, most = ((places or 0) // FANOUT, most) if (places or 0) > 0 else (0, (most or 0) // FANOUT)
        grouped = levels[-1].groupBy(F.col("parent").alias("node")).agg(*[(F.min if n.startswith("lo") else F.max)(n).alias(n) for n in names])
        up = F.struct(F.col("node.part").alias("part"), (F.col("node.place") / FANOUT).cast("long").alias("place")) if inner else F.struct((F.col("node.part") / FANOUT).cast("long").alias("part"), F.lit(0).cast("long").alias("place"))
        levels.append(stored(grouped.withColumn("parent", up), "ego-level"))
    return levels


def _near_blocks(levels: list[DataFrame]) -> DataFrame:
    """Pairs of blocks that may hold links, found from the top of the sequence down."""
    names = [f"{s}_{c}" for c in ["label", "size", *[f"c{k}" for k in range(AXES)]] for s in ("lo", "hi")]
    side = lambda rows, x: rows.select(F.col("node").alias(x), F.col("parent").alias(f"parent_{x}"), *[F.col(n).alias(f"{n}_{x}") for n in names])

    def near(c: str, gap: int):
        a_lo, a_hi, b_lo, b_hi = (F.col(f"{s}_{c}_{x}") for x in "ab" for s in ("lo", "hi"))
        return (a_lo <= b_hi + gap) & (b_lo <= a_hi + gap) if gap else (a_lo <= b_hi) & (b_lo <= a_hi)

    fits = reduce(lambda x, y: x & y, [near("label", 0), near("size", 0), *[near(f"c{k}", 1) for k in range(AXES)]]) & (F.col("a") <= F.col("b"))
    pairs: DataFrame | None = None
    for rows in reversed(levels):
        if pairs is None:
            top = side(rows, "a").join(side(rows, "b"), F.col("parent_a") == F.col("parent_b"))
            pairs = stored(top.filter(fits).select("a", "b"), "ego-pairs")
            continue
        above = pairs.select(F.col("a").alias("parent_a"), F.col("b").alias("parent_b"))
        pairs = stored(above.join(side(rows, "a"), "parent_a").join(side(rows, "b"), "parent_b").filter(fits).select("a", "b"), "ego-pairs")
    return pairs


def link_blocks(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray, least: float, same: bool) -> np.ndarray:
    """Which rows of ``x`` are linked with which of ``y``; with ``same`` both are one block and nothing links itself."""
    linked = (x @ y.T) / (nx[:, None] * ny[None]) >= least
    if same:
        linked |= linked.T
        np.fill_diagonal(linked, False)
    return linked


def _representatives(linked: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The smallest member of each row's and column's component; rows come before columns unless both are the same."""
    n, m = linked.shape
    most = n + m
    rows, columns = np.arange(n), np.arange(m) + (0 if same else n)
    while True:
        new_columns = np.minimum(columns, np.where(linked, rows[:, None], most).min(axis=0, initial=most))
        if same:
            new_columns = np.minimum(new_columns, rows)
        new_rows = np.minimum(rows, np.where(linked, new_columns[None], most).min(axis=1, initial=most))
        if (new_rows == rows).all() and (new_columns == columns).all():
            return rows, columns
        rows, columns = new_rows, (np.minimum(new_columns, new_rows) if same else new_columns)
        if same:
            rows = columns


def _links(blocks: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """For each member of a pair of blocks with links there: their number and a representative of its component."""
    held = lambda x: blocks.select(F.struct("part", "place").alias(x), F.col("members").alias(f"m_{x}"), F.col("raw").alias(f"r_{x}"), F.col("counts").alias(f"k_{x}"), F.col("label").alias(f"l_{x}"), F.col("size").alias(f"s_{x}"))
    both = pairs.join(held("a"), "a").join(held("b"), "b").filter((F.col("l_a") == F.col("l_b")) & (F.col("s_a") == F.col("s_b")))
    both = both.select((F.col("a") == F.col("b")).alias("same"), "s_a", "m_a", "r_a", "k_a", "m_b", "r_b", "k_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                same, size, *cells = (batch.column(c)[i].as_py() for c in range(8))
                (ma, x, ka), (mb, y, kb) = (
                    (np.frombuffer(m, "V16"), np.frombuffer(r, np.float64).reshape(-1, size), np.frombuffer(k, np.int64)) for m, r, k in (cells[:3], cells[3:])
                )
                nx, ny = (np.sqrt(np.einsum("ij,ij->i", z, z)) for z in (x, y))
                linked = link_blocks(x, nx, y, ny, least, same)
                rows, columns = _representatives(linked, same)
                names = ma if same else np.concatenate([ma, mb])
                sides = [(ma, rows, linked @ kb, linked.any(axis=1))]
                if not same:
                    sides.append((mb, columns, linked.T @ ka, linked.any(axis=0)))
                for who, root, n, some in sides:
                    if some.any():
                        arrays = [pa.array([v.tobytes() for v in who[some]], pa.binary()), pa.array([v.tobytes() for v in names[root[some]]], pa.binary()), pa.array(n[some].astype(np.int64))]
                        yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "n"])

    return both.mapInArrow(run, "a binary, b binary, n long")


def near_vectors(embeddings: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of ``embeddings``: ``vec_id``, ``n_links`` (other vectors linked directly), ``component_id``
    (smallest id reachable, itself included) and ``kept`` (whether that is the row itself)."""
    given = embeddings.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    rows = stored(_vectors(given), "ego-vectors")
    classes = stored(
        rows.filter(F.col("class").isNotNull()).groupBy("class", "label", "size").agg(F.first("raw").alias("raw"), F.count("*").alias("n"), F.min("id").alias("least")), "ego-classes"
    )
    # A little over the largest distance, so that rounding never moves a link out of reach.
    width = math.sqrt(max(0.0, 2 - 2 * least)) + 1e-6
    blocks = stored(_ordered_blocks(classes, principal_axes(classes), width), "ego-blocks")
    pairs = _near_blocks(_boxes(blocks))
    found = stored(_links(blocks, pairs, least), "ego-links", batch_rows=32)
    counts = found.groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("links"))
    labels = components(found.select("a", "b")).withColumnRenamed("node", "class")
    per_class = classes.select("class", "n", "least").join(counts, "class", "left").join(labels, "class", "left")
    per_class = stored(per_class.withColumn("component", F.coalesce("component", "class")), "ego-result")
    lowest = per_class.groupBy("component").agg(F.min("least").alias("component_id"))
    own = per_class.join(lowest, "component").select("class", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.select("id", "class").join(own, "class", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )
