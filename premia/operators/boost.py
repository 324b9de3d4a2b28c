"""Histogram gradient boosting as Spark jobs: log link, Poisson or Tweedie loss, weights, monotone constraints.

Rows hold one small integer per feature (its bin). Trees grow best-first: the leaf with the largest gain is split next,
until the leaf budget is used up. A split needs the histograms of its two children; the smaller one is counted, the other
is its parent's minus that. One job counts the smaller children of all leaves that may still be split (as many as the
budget allows, best first), whether they are accepted already or not, so a tree takes about as many jobs as it is deep,
and the order of the splits is still that of splitting one leaf after the other.

Tasks fold their rows into (node, feature, bin) sums before anything is shuffled; what reaches the driver is bounded by
leaves x features x bins, whatever the table size. Margins are written to the shared folder every few trees. With a
progress folder finished trees are published there, and a fit that starts again goes on after the last one.
"""

from __future__ import annotations

import heapq
import json
import math
import random
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premia.functions.bins import edges_below
from premia.operators.quantiles import cut_points
from premia.settings import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from premia.sources import commits
from premia.workspace import discard, stored

MAX_BINS = 256
LEAST_GAIN = 1e-9
#: Leaves that one job counts for at least, where there are so many: near the end of the budget this saves jobs.
AHEAD = 16
#: Rows of a block of the table that the passes read.
BLOCK_ROWS = 10_000


@dataclass(frozen=True)
class BoostParams:
    """``depth`` None means that only ``leaves`` bounds a tree."""

    loss: str = "poisson"
    power: float = 1.5
    trees: int = 100
    leaves: int = 31
    depth: int | None = None
    learning_rate: float = 0.1
    min_child_rows: int = 20
    ridge: float = 0.0
    feature_share: float = 1.0
    bins: int = 255
    increasing: tuple[str, ...] = ("bonus_malus",)
    seed: int = 42
    store_every: int = 10


@dataclass
class Binning:
    """Cut points per numeric feature, sorted levels per categorical feature."""

    cuts: dict[str, list[float]]
    levels: dict[str, list[str]]

    @property
    def features(self) -> list[str]:
        return [*self.cuts, *self.levels]

    def column(self, feature: str) -> Column:
        """Bin of a row; an unseen level is bin -1, which belongs to no left side."""
        if feature in self.cuts:
            edges = F.expr("array(" + ", ".join(f"{c!r}D" for c in self.cuts[feature]) + ")")
            if not self.cuts[feature]:
                return F.lit(0)
            return edges_below(edges, F.col(feature).cast("double"), MAX_BINS)
        listed = F.array(*[F.lit(v) for v in self.levels[feature]])
        return (F.array_position(listed, F.col(feature)) - 1).cast("int")

    def size(self, feature: str) -> int:
        return len(self.cuts[feature]) + 1 if feature in self.cuts else len(self.levels[feature])


@dataclass
class Split:
    """Rows go left when their bin is at most ``upto`` (numeric) or among ``left_bins`` (categorical); a missing bin
    (-1) goes right."""

    feature: str
    upto: int | None = None
    left_bins: list[int] = field(default_factory=list)

    def goes_left(self, bins: np.ndarray) -> np.ndarray:
        if self.upto is not None:
            return (bins >= 0) & (bins <= self.upto)
        left = np.zeros(MAX_BINS + 1, bool)
        left[[b + 1 for b in self.left_bins]] = True
        return left[bins + 1]


@dataclass
class Tree:
    """Node 0 is the root; children of a split node carry explicit numbers."""

    splits: dict[int, Split] = field(default_factory=dict)
    children: dict[int, tuple[int, int]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)
    rows: dict[int, int] = field(default_factory=dict)

    def leaves(self) -> list[int]:
        return [n for n in self.values if n not in self.children]

    def depth(self, node: int = 0) -> int:
        return 1 + max(map(self.depth, self.children[node])) if node in self.children else 0

    def leaf_rows(self, bins: np.ndarray, features: list[str], wanted: set[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, its ascending row numbers in ``bins``) for the leaves that hold rows, or for those of ``wanted`` alone:
        rows that reach none of them are left behind at the first split that parts them."""
        on_path = None if wanted is None else self._ancestors(wanted)
        todo = [(0, np.arange(len(bins)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows) or (on_path is not None and node not in on_path):
                continue
            if node not in self.children:
                yield node, rows
                continue
            split, (left, right) = self.splits[node], self.children[node]
            goes = split.goes_left(bins[rows, features.index(split.feature)])
            todo += [(left, rows[goes]), (right, rows[~goes])]

    def _ancestors(self, nodes: set[int]) -> set[int]:
        parent = {child: node for node, pair in self.children.items() for child in pair}
        found = set()
        for node in nodes:
            while node is not None and node not in found:
                found.add(node)
                node = parent.get(node)
        return found

    def places(self, bins: np.ndarray, features: list[str]) -> np.ndarray:
        """The leaf of every row of ``bins`` (rows x features)."""
        at = np.zeros(len(bins), np.intp)
        for node, rows in self.leaf_rows(bins, features):
            at[rows] = node
        return at

    def outputs(self, bins: np.ndarray, features: list[str]) -> np.ndarray:
        values = np.zeros(max(self.values) + 1)
        values[list(self.values)] = list(self.values.values())
        return values[self.places(bins, features)]

    @staticmethod
    def from_dict(raw: dict) -> "Tree":
        return Tree(
            {int(k): Split(**v) for k, v in raw["splits"].items()},
            {int(k): tuple(v) for k, v in raw["children"].items()},
            {int(k): v for k, v in raw["values"].items()},
            {int(k): v for k, v in raw["rows"].items()},
        )


@dataclass
class BoostedModel:
    params: BoostParams
    binning: Binning
    base: float
    trees: list[Tree]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "BoostedModel":
        raw = json.loads(text)
        params = BoostParams(**{**raw["params"], "increasing": tuple(raw["params"]["increasing"])})
        return BoostedModel(params, Binning(**raw["binning"]), raw["base"], [Tree.from_dict(t) for t in raw["trees"]])


def fit_binning(df: DataFrame, bins: int, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES) -> Binning:
    """Quantile cut points and level lists; levels are counted before any list of them is made."""
    if not 2 <= bins <= MAX_BINS:
        raise ValueError(f"bins must be from 2 to {MAX_BINS}, not {bins}")
    counted = df.agg(*[cut_points(F.col(c).cast("double"), bins).alias(c) for c in numeric], *[F.approx_count_distinct(c).alias(c) for c in categorical]).first()
    # The sketch is off by a few per cent; the exact check follows on lists of that size at most.
    if any(counted[c] > 2 * MAX_BINS for c in categorical):
        raise ValueError("a categorical feature has too many levels for boosting")
    found = df.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in categorical]).first() if categorical else {}
    if any(len(found[c]) > MAX_BINS for c in categorical):
        raise ValueError("a categorical feature has too many levels for boosting")
    return Binning({c: list(counted[c]) for c in numeric}, {c: list(found[c]) for c in categorical})


def category_codes(df: DataFrame, binning: Binning, keep: list[str]) -> DataFrame:
    """Numeric features as they are, categorical features as codes in sorted level order."""
    return df.select(*keep, *binning.cuts, *[binning.column(c).alias(c) for c in binning.levels])


def binned(df: DataFrame, binning: Binning, keep: list[str]) -> DataFrame:
    """``keep`` and a short ``b_<feature>`` per feature. Numeric features are searched among their cuts with numpy, a batch
    at a time; like ``Binning.column`` this gives 0 for null and the last bin for NaN."""
    levels = {f"b_{f}": F.coalesce(binning.column(f), F.lit(-1)).cast("short") for f in binning.levels}
    numeric = {f"b_{f}": F.col(f).cast("double") for f in binning.cuts}
    rows = df.select(*keep, *[c.alias(n) for n, c in (numeric | levels).items()])
    if not numeric:
        return rows
    names, edges = rows.columns, {f"b_{f}": np.array(cuts, float) for f, cuts in binning.cuts.items()}

    def place(name: str, values: pa.Array) -> pa.Array:
        x = values.to_numpy(zero_copy_only=False)
        at = np.where(np.isnan(x), len(edges[name]), np.searchsorted(edges[name], x)).astype(np.int16)
        if values.null_count:
            at[values.is_null().to_numpy(zero_copy_only=False)] = 0
        return pa.array(at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [place(n, c) if n in edges else c for n, c in zip(names, batch.columns, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType([T.StructField(f.name, T.ShortType() if f.name in edges else f.dataType) for f in rows.schema])
    return rows.mapInArrow(run, schema)


def _bins_of(batch: pa.RecordBatch, features: list[str]) -> np.ndarray:
    """Rows x features, each feature in one piece, because splits and histograms read one feature at a time."""
    out = np.empty((batch.num_rows, len(features)), np.int16, order="F")
    for no, feature in enumerate(features):
        out[:, no] = batch.column(f"b_{feature}").to_numpy()
    return out


PACKED = "n int, bins binary, y binary, w binary, m binary"


def packed(rows: DataFrame, features: list[str]) -> DataFrame:
    """``y, w, m`` and bins in blocks of many rows: every pass over a block costs Spark one row, and numpy reads the
    numbers where they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, BLOCK_ROWS) for at in range(0, batch.num_rows, BLOCK_ROWS)):
                yield _block(_bins_of(part, features), *(part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "m")))

    return rows.mapInArrow(run, PACKED)


def _block(bins: np.ndarray, *numbers: np.ndarray) -> pa.RecordBatch:
    """Bins take one byte, raised by one because of -1, unless there are 256 of them and -1: then they take two."""
    if bins.max(initial=0) < 255:
        bins = (bins + 1).astype(np.uint8)
    cells = [pa.array([bins.tobytes(order="F")], pa.binary()), *[pa.array([x.astype(np.float64).tobytes()], pa.binary()) for x in numbers]]
    return pa.RecordBatch.from_arrays([pa.array([len(bins)], pa.int32()), *cells], ["n", "bins", "y", "w", "m"])


def _blocks(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bins, y, w, m) of each block."""
    for batch in batches:
        for no, n in enumerate(batch.column("n").to_pylist()):
            raw = [batch.column(c)[no].as_buffer() for c in ("bins", "y", "w", "m")]
            if raw[0].size > n * n_features:
                bins = np.frombuffer(raw[0], np.int16)
            else:
                bins = np.subtract(np.frombuffer(raw[0], np.uint8), 1, dtype=np.int16)
            yield bins.reshape(n, n_features, order="F"), *(np.frombuffer(x, np.float64) for x in raw[1:])


def gradients(params: BoostParams, y: np.ndarray, w: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the weighted half deviance in the margin ``m``."""
    if params.loss == "poisson":
        mu = np.exp(m)
        return w * (mu - y), w * mu
    if params.loss != "tweedie":
        raise ValueError(f"unknown loss {params.loss!r}")
    a, b = 1 - params.power, 2 - params.power
    low, high = np.exp(a * m), np.exp(b * m)
    return w * (high - y * low), w * (b * high - a * y * low)


def _counted(params: BoostParams, features: list[str], all_features: list[str], pending: list[Tree], tree: Tree, slot_of: dict[int, int]):
    """Fold the rows of a task into (code, g, h, n) with code = (slot, feature, bin) for the leaves in ``slot_of``."""
    width = len(features) * MAX_BINS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By slot, feature and bin: what a batch adds is one feature of all slots.
        sums = np.zeros((3, len(slot_of), len(features), MAX_BINS))
        own, wanted = [all_features.index(f) for f in features], set(slot_of)
        for bins, y, w, m in _blocks(batches, len(all_features)):
            slot = np.full(len(bins), -1)
            for node, rows in tree.leaf_rows(bins, all_features, wanted):
                slot[rows] = slot_of[node]
            here = np.flatnonzero(slot >= 0)
            if not len(here):
                continue
            if len(here) < len(bins):
                # One feature at a time, as they lie.
                bins, slot = bins.T[:, here].T, slot[here]
                y, w, m = y[here], w[here], m[here]
            for one in pending:
                m = m + one.outputs(bins, all_features)
            g, h = gradients(params, y, w, m)
            first, size = slot * MAX_BINS, len(slot_of) * MAX_BINS
            for no, column in enumerate(own):
                code, weights = first + bins[:, column], (g, h, None)
                known = bins[:, column] >= 0
                if not known.all():
                    code, weights = code[known], (g[known], h[known], None)
                for k, value in enumerate(weights):
                    sums[k, :, no] += np.bincount(code, value, size).reshape(-1, MAX_BINS)
        sums = sums.reshape(3, len(slot_of) * width)
        at = np.flatnonzero(sums[2])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), *[pa.array(s[at]) for s in sums]], ["code", "g", "h", "n"])

    return run


def histograms(rows: DataFrame, params: BoostParams, features: list[str], all_features: list[str], pending: list[Tree], tree: Tree, nodes: list[int]) -> dict[int, np.ndarray]:
    """Sums of gradient, second derivative and rows per (feature, bin) of each leaf in ``nodes``."""
    slot_of = {node: i for i, node in enumerate(nodes)}
    folded = rows.mapInArrow(_counted(params, features, all_features, pending, tree, slot_of), "code long, g double, h double, n double")
    found = folded.groupBy("code").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")]).toArrow()
    dense = np.zeros((3, len(nodes) * len(features) * MAX_BINS))
    dense[:, found.column("code").to_numpy()] = [found.column(c).to_numpy() for c in ("g", "h", "n")]
    dense = dense.reshape(3, len(nodes), len(features), MAX_BINS)
    return {node: dense[:, i] for node, i in slot_of.items()}


@dataclass
class Candidate:
    """The best split of a leaf."""

    gain: float
    split: Split
    left: tuple[float, int]
    right: tuple[float, int]


def best_split(hist: np.ndarray, features: list[str], binning: Binning, params: BoostParams, bounds: tuple[float, float]) -> Candidate | None:
    """The split with the largest gain of one leaf (histogram 3 x features x bins); the first feature and cut win ties.

    ``bounds`` limit the values of the two new leaves.
    """
    low, high = bounds
    best = None
    for no, feature in enumerate(features):
        present = np.flatnonzero(hist[2, no])
        if len(present) < 2:
            continue
        g, h, n = hist[:, no, present]
        order = np.arange(len(present)) if feature in binning.cuts else np.argsort(g / (h + 1e-12), kind="stable")
        left = np.cumsum(hist[:, no, present[order]], axis=1)
        total, left = left[:, -1:], left[:, :-1]
        right = total - left

        def value(s):
            return np.clip(-s[0] / np.maximum(s[1] + params.ridge, 1e-300), low, high)

        def reduction(s, v):
            return -(s[0] * v + 0.5 * (s[1] + params.ridge) * v * v)

        lv, rv = value(left), value(right)
        gain = reduction(left, lv) + reduction(right, rv) - reduction(total, value(total))
        allowed = (left[2] >= params.min_child_rows) & (right[2] >= params.min_child_rows)
        if feature in params.increasing:
            allowed &= lv <= rv
        gain = np.where(allowed, gain, -np.inf)
        at = int(np.argmax(gain))
        if gain[at] > LEAST_GAIN and (best is None or gain[at] > best.gain):
            bins = present[order]
            split = Split(feature, upto=int(bins[at])) if feature in binning.cuts else Split(feature, left_bins=sorted(int(b) for b in bins[: at + 1]))
            best = Candidate(float(gain[at]), split, (float(lv[at]), int(left[2, at])), (float(rv[at]), int(right[2, at])))
    return best


def grow_tree(count, binning: Binning, params: BoostParams, features: list[str]) -> Tree:
    """Best-first growth. ``count(tree, nodes)`` gives the histograms of leaves of a tree.

    ``trial`` holds the splits whose histograms are known, the result those that best-first order accepts; a trial split
    that is not accepted costs its share of a job and nothing else.
    """
    trial, result = Tree(values={0: 0.0}), Tree()
    bounds, depths, found = {0: (-math.inf, math.inf)}, {0: 0}, {}
    hist = count(trial, [0])
    # Every row has a bin of the first feature, or none of it has one and no feature splits.
    totals = hist[0].sum(axis=2).max(axis=1) if not len(features) else hist[0][:, 0].sum(axis=1)
    result.values[0], result.rows[0] = float(-totals[0] / (totals[1] + params.ridge)) if totals[2] else 0.0, int(totals[2])
    next_id = 1

    def judge(node):
        if params.depth is not None and depths[node] >= params.depth:
            return
        candidate = best_split(hist[node], features, binning, params, bounds[node])
        if candidate:
            found[node] = candidate
        else:
            del hist[node]

    judge(0)
    queue = [(-found[0].gain, 0)] if found else []
    while queue and len(result.leaves()) < params.leaves:
        # Accept the best leaf as long as its children are known.
        node = queue[0][1]
        if node in trial.children:
            heapq.heappop(queue)
            candidate, (left, right) = found[node], trial.children[node]
            result.splits[node], result.children[node] = candidate.split, (left, right)
            for child, (value, rows) in ((left, candidate.left), (right, candidate.right)):
                result.values[child], result.rows[child] = value, rows
                if child in found:
                    heapq.heappush(queue, (-found[child].gain, child))
            continue
        # Count for the leaves that the budget may still reach, those of trial splits included.
        most = params.leaves - len(result.leaves())
        if most == 1:
            # The last split: its children need no histograms.
            wanted = [node]
        else:
            ahead = heapq.nsmallest(max(most, AHEAD), ((-found[n].gain, n) for n in found if n not in trial.children))
            wanted = sorted({node, *(n for _, n in ahead)})
        small = {}
        for n in wanted:
            candidate, (left, right) = found[n], (next_id, next_id + 1)
            next_id += 2
            trial.splits[n], trial.children[n] = candidate.split, (left, right)
            trial.values[left] = trial.values[right] = 0.0
            depths[left] = depths[right] = depths[n] + 1
            bounds[left] = bounds[right] = bounds[n]
            if candidate.split.feature in params.increasing:
                middle = (candidate.left[0] + candidate.right[0]) / 2
                bounds[left], bounds[right] = (bounds[n][0], middle), (middle, bounds[n][1])
            small[n] = left if candidate.left[1] <= candidate.right[1] else right
        if most > 1:
            counted = count(trial, list(small.values()))
            for n, child in small.items():
                left, right = trial.children[n]
                other = right if child == left else left
                hist[child] = counted[child]
                rest = hist.pop(n) - counted[child]
                # Bins that the smaller child emptied hold nothing but rounding.
                hist[other] = np.where(rest[2] > 0.5, rest, 0.0)
                judge(left)
                judge(right)
    result.values = {n: v * params.learning_rate for n, v in result.values.items()}
    return _renumbered(result)


def _renumbered(tree: Tree) -> Tree:
    """Nodes numbered in the order of the splits, without the gaps of trial splits."""
    number = {0: 0}
    for node in tree.splits:
        for child in tree.children[node]:
            number[child] = len(number)
    return Tree(
        {number[n]: s for n, s in tree.splits.items()},
        {number[n]: (number[a], number[b]) for n, (a, b) in tree.children.items()},
        {number[n]: tree.values[n] for n in number},
        {number[n]: tree.rows[n] for n in number},
    )


def with_margin(rows: DataFrame, trees: list[Tree], features: list[str]) -> DataFrame:
    """Add the trees' values to the margin ``m`` of ``packed`` rows."""
    if not trees:
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, y, w, m in _blocks(batches, len(features)):
            for tree in trees:
                m = m + tree.outputs(bins, features)
            yield _block(bins, y, w, m)

    return rows.mapInArrow(run, PACKED)


def _tree_file(folder: str, no: int) -> str:
    return f"{folder}/tree-{no:06d}.json"


def finished_trees(spark, folder: str) -> list[Tree]:
    """The trees that an earlier run of the same fit published, without gaps."""
    out = []
    there = set(commits.names(spark, folder))
    while _tree_file("", len(out))[1:] in there:
        out.append(Tree.from_dict(json.loads(commits.read_text(spark, _tree_file(folder, len(out))))))
    return out


def boost_table(train: DataFrame, bins: int, offset: Column | None = None, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES) -> tuple[DataFrame, Binning, float]:
    """``packed`` rows, written once, with the binning and the constant margin: what all fits of a search share."""
    binning = fit_binning(train, bins, numeric, categorical)
    keep = train.withColumn("o", offset if offset is not None else F.lit(0.0))
    totals = keep.agg(F.sum(F.col("w") * F.col("y")).alias("wy"), F.sum(F.col("w") * F.exp("o")).alias("w")).first()
    base = math.log(totals["wy"] / totals["w"])
    double = [F.col(c).cast("double").alias(c) for c in ("y", "w")]
    rows = binned(keep.withColumn("m", F.lit(base) + F.col("o")), binning, [*double, "m"])
    return stored(packed(rows, binning.features), "boost-rows"), binning, base


def fit_boosted(
    train: DataFrame | None,
    params: BoostParams,
    offset: Column | None = None,
    numeric=NUMERIC_FEATURES,
    categorical=CATEGORICAL_FEATURES,
    table: tuple[DataFrame, Binning, float] | None = None,
    progress: str | None = None,
) -> BoostedModel:
    """``train`` carries y, w and the raw features.

    With ``offset`` (a log exposure) y is a count and w is 1; without it y is a rate and w the exposure. Both forms
    give the same model, and predictions are rates in both. ``table`` is a ``boost_table`` to use instead of ``train``.
    ``progress`` names a folder of this fit alone: finished trees go there, and a fit that finds trees goes on after
    them. A feature in ``increasing`` that the rows do not have is an error.

    The rows of the passes are cached while the fit lasts: what does not fit into memory goes to disk, and what is lost with
    an executor is read from the stored table again. Tables of margins are deleted when the next one is stored.
    """
    unknown = [f for f in params.increasing if f not in (*numeric, *categorical)]
    if unknown:
        raise ValueError(f"monotone features are not among the features: {unknown}")
    rows, binning, base = table or boost_table(train, params.bins, offset, numeric, categorical)
    spark = rows.sparkSession
    model = BoostedModel(params, binning, base, finished_trees(spark, progress) if progress else [])
    names = binning.features
    shared = rows
    if model.trees:
        rows = stored(with_margin(rows, model.trees, names), "boost-rows")
    pending: list[Tree] = []
    rng = random.Random(params.seed)
    try:
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        for no in range(params.trees):
            chosen = set(rng.sample(names, max(1, round(params.feature_share * len(names)))))
            if no < len(model.trees):
                continue
            features = [f for f in names if f in chosen]

            def count(tree, nodes, features=features):
                return histograms(rows, params, features, names, pending, tree, nodes)

            tree = grow_tree(count, binning, params, features)
            if progress:
                commits.publish(spark, _tree_file(progress, no), json.dumps(asdict(tree)))
            model.trees.append(tree)
            pending.append(tree)
            if len(pending) >= params.store_every:
                old, rows, pending = rows, stored(with_margin(rows, pending, names), "boost-rows"), []
                old.unpersist()
                if old is not shared:
                    discard(old)
                rows.persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        rows.unpersist()
        if rows is not shared:
            discard(rows)
    return model


def score_boosted(df: DataFrame, model: BoostedModel, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``yhat``. Trees are walked with numpy on Arrow batches: hundreds of trees exceed what one
    generated CASE expression can hold."""
    rows = binned(df, model.binning, keep)
    text = model.to_json()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = BoostedModel.from_json(text)
        for batch in batches:
            bins = _bins_of(batch, own.binning.features)
            margin = np.full(batch.num_rows, own.base)
            for tree in own.trees:
                margin += tree.outputs(bins, own.binning.features)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(np.exp(margin))], [*keep, "yhat"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields)
    return rows.mapInArrow(walk, f"{schema}, yhat double")


def tree_table(spark, tree: Tree, binning: Binning) -> DataFrame:
    """One row per split, in the order they were made."""
    found = []
    for no, (node, split) in enumerate(tree.splits.items()):
        cut = float(binning.cuts[split.feature][split.upto]) if split.upto is not None else None
        levels = [binning.levels[split.feature][b] for b in split.left_bins] if split.upto is None else None
        left, right = tree.children[node]
        found.append((no, node, split.feature, cut, levels, tree.rows[left], tree.rows[right], tree.values[left], tree.values[right]))
    return spark.createDataFrame(pd.DataFrame(found, columns=TREE_COLUMNS).values.tolist(), TREE) if found else spark.createDataFrame([], TREE)


TREE = "no int, node int, feature string, upto double, left_levels array<string>, left_rows long, right_rows long, left_value double, right_value double"
TREE_COLUMNS = [c.split()[0] for c in TREE.split(", ")]
