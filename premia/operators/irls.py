"""Many ridge GLMs with log link at once: one pass over the rows per Newton step serves every fit of a grid.

The objective is that of ``glm``: sum(w * deviance / 2) / sum(w) + alpha / 2 * |beta|^2. Each task adds up, for every fit
that has not converged, the upper triangle of X'HX, the gradient and the objective; the driver gets these sums (terms
squared per fit, whatever the number of rows) and solves by Cholesky. The step is Newton's with the second derivative of
the deviance itself, so that Tweedie and gamma fits converge quadratically, too; where a step makes the objective worse,
it is halved.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.operators.design import DesignSpec, codes, expanded, terms
from premia.operators.glm import POWERS, FittedGlm, NotConverged
from premia.workspace import stored

#: Relative decrease of the objective below which a step may not fall without being halved, and steps of that kind.
SLACK, HALVINGS = 1e-12, 40
#: Row groups of the stored rows: small, because a pass costs much per byte and its tasks should get even shares.
ROW_GROUP_BYTES = 4 << 20


@dataclass(frozen=True)
class Point:
    """One fit: the part whose rows and design it uses, its family and its penalty."""

    part: int
    family: str
    alpha: float
    power: float | None = None

    @property
    def p(self) -> float:
        found = POWERS.get(self.family, self.power)
        if found is None:
            raise ValueError("power is required for the tweedie family")
        return found


@dataclass
class _State:
    beta: np.ndarray
    step: np.ndarray
    objective: float = np.inf
    halved: int = 0
    done: bool = False


def stack(parts: dict[int, tuple[DataFrame, DesignSpec]]) -> DataFrame:
    """``part, x, y, w``: the rows of all parts, written once, as the few numbers that their terms follow from. Rows carry
    the design's sources, y and w."""
    encoded = [
        rows.select(F.lit(part).alias("part"), F.array(*[F.expr(c) for c in codes(spec)]).alias("x"), F.col("y").cast("double").alias("y"), F.col("w").cast("double").alias("w"))
        for part, (rows, spec) in parts.items()
    ]
    return stored(reduce(DataFrame.unionByName, encoded), "glm-rows", **{"parquet.block.size": ROW_GROUP_BYTES})


def _slopes(p: float, eta: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half deviance up to a term of y alone, and its first and second derivative in the linear predictor."""
    if p == 1:
        mu = np.exp(eta)
        return mu - y * eta, mu - y, mu
    if p == 2:
        ratio = y * np.exp(-eta)
        return ratio + eta, 1 - ratio, ratio
    a, b = np.exp((1 - p) * eta), np.exp((2 - p) * eta)
    return b / (2 - p) - y * a / (1 - p), b - y * a, (2 - p) * b - (1 - p) * y * a


def _summed(points: list[tuple[int, int, float, np.ndarray]], designs: dict[int, DesignSpec]):
    """Per task: (fit, at, value) with the upper triangle, the gradient and the objective of each fit in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {fit: [np.zeros((len(beta), len(beta))), np.zeros(len(beta)), 0.0] for fit, _, _, beta in points}
        for batch in batches:
            part = batch.column("part").to_numpy()
            y, w = batch.column("y").to_numpy(), batch.column("w").to_numpy()
            lists = batch.column("x")
            for no in np.unique(part):
                mine = [q for q in points if q[1] == no]
                if not mine:
                    continue
                here = np.flatnonzero(part == no)
                flat = lists.take(pa.array(here)).flatten().to_numpy()
                x = expanded(designs[int(no)], flat.reshape(len(here), -1))
                for fit, _, p, beta in mine:
                    with np.errstate(over="ignore", invalid="ignore"):
                        value, first, second = _slopes(p, x @ beta, y[here])
                        total = sums[fit]
                        # The second derivative is not negative; a product with its own transpose takes half the time.
                        half = x * np.sqrt(w[here] * second)[:, None]
                        total[0] += half.T @ half
                        total[1] += x.T @ (w[here] * first)
                        total[2] += float(w[here] @ value)
        for fit, (square, slope, value) in sums.items():
            row = np.concatenate([square[np.triu_indices(len(slope))], slope, [value]])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), fit, np.int32)), pa.array(np.arange(len(row), dtype=np.int32)), pa.array(row)], ["fit", "at", "value"])

    return run


def _unpacked(row: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    n = int(np.sqrt(2 * len(row) + 0.25) - 1.5)
    square = np.zeros((n, n))
    square[np.triu_indices(n)] = row[: n * (n + 1) // 2]
    square += np.triu(square, 1).T
    return square, row[n * (n + 1) // 2 : -1], float(row[-1])


def _newton(square: np.ndarray, slope: np.ndarray) -> np.ndarray:
    try:
        lower = np.linalg.cholesky(square)
        return np.linalg.solve(lower.T, np.linalg.solve(lower, -slope))
    except np.linalg.LinAlgError:
        # Without a penalty dependent terms leave directions free: take the shortest step.
        return np.linalg.lstsq(square, -slope, rcond=1e-12)[0]


def _advance(state: _State, alpha: float, weight: float, row: np.ndarray, tolerance: float) -> None:
    square, slope, value = _unpacked(row)
    ridge = np.full(len(slope), alpha)
    ridge[0] = 0.0
    objective = value / weight + 0.5 * float(ridge @ state.beta**2)
    if not objective <= state.objective + SLACK * abs(state.objective) and state.halved < HALVINGS and np.isfinite(state.objective):
        state.step = state.step / 2
        state.beta = state.beta - state.step
        state.halved += 1
        return
    state.objective, state.halved = objective, 0
    state.step = _newton(square / weight + np.diag(ridge), slope / weight + ridge * state.beta)
    if np.abs(state.step).max() < tolerance:
        state.done = True
    state.beta = state.beta + state.step


def fit_many(rows: DataFrame, designs: dict[int, DesignSpec], points: list[Point], max_iter: int = 1000, tolerance: float = 1e-9) -> list[FittedGlm]:
    """Fit every point on its part of ``rows`` (see ``stack``); all fits advance together, a converged one drops out."""
    if not points:
        return []
    totals = {
        r["part"]: (r["w"], r["wy"])
        for r in rows.groupBy("part").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("wy")).collect()
    }
    states = []
    for point in points:
        weight, target = totals[point.part]
        start = np.zeros(len(terms(designs[point.part])) + 1)
        start[0] = np.log(target / weight)
        states.append(_State(start, np.zeros_like(start)))
    for _ in range(max_iter):
        open_fits = [(i, points[i].part, points[i].p, s.beta) for i, s in enumerate(states) if not s.done]
        if not open_fits:
            break
        sums = rows.mapInArrow(_summed(open_fits, designs), "fit int, at int, value double")
        found = sums.groupBy("fit", "at").agg(F.sum("value").alias("value")).toPandas().sort_values(["fit", "at"])
        for fit, part in found.groupby("fit"):
            _advance(states[fit], points[fit].alpha, totals[points[fit].part][0], part["value"].to_numpy(), tolerance)
    else:
        raise NotConverged(f"{sum(not s.done for s in states)} of {len(states)} fits did not converge in {max_iter} steps")
    return [
        FittedGlm(point.family, point.p, point.alpha, float(s.beta[0]), [float(b) for b in s.beta[1:]], designs[point.part])
        for point, s in zip(points, states, strict=True)
    ]
