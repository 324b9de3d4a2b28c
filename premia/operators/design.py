"""Design matrix of the linear models: spline, scaled, ordinal and one-hot terms as SQL expressions.

``DesignSpec`` holds what was learned from the training rows; it is small, JSON-serialisable and turns any DataFrame
with the source columns into the encoded terms.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.functions.spline import basis, combination, number
from premia.settings import Features

SPLINE_SOURCES = ("driv_age", "veh_age")
SCALED_SOURCES = ("log_density", "bonus_malus")
ONE_HOT_SOURCES = ("veh_brand", "region", "veh_gas", "veh_power_band")
GLM_SOURCES = (*SPLINE_SOURCES, *SCALED_SOURCES, "area", *ONE_HOT_SOURCES)
MAX_LEVELS = 2000


@dataclass(frozen=True)
class Term:
    """One encoded column: its name, the source feature it comes from and its SQL expression."""

    name: str
    source: str
    sql: str

    @property
    def value(self) -> Column:
        return F.expr(self.sql)


@dataclass(frozen=True)
class DesignSpec:
    splines: dict[str, list[float]] = field(default_factory=dict)
    knots: int = 5
    scaled: dict[str, list[float]] = field(default_factory=dict)
    area_levels: list[str] = field(default_factory=list)
    one_hot: dict[str, list[str]] = field(default_factory=dict)
    interactions: bool = False

    def to_dict(self) -> dict:
        return asdict(self)


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _by_level(column: str, values: dict[str, float]) -> str:
    """The value of each level, looked up in a constant map; an unknown level raises."""
    pairs = ", ".join(f"{_text(level)}, {number(v)}" for level, v in values.items())
    message = f"concat('unseen {column}: ', coalesce({column}, 'null'))"
    return f"coalesce(try_element_at(map({pairs}), {column}), cast(raise_error({message}) AS double))"


def area_rank(levels, column: str = "area") -> str:
    """Position of the area in the configured order, from 0."""
    return _by_level(column, {level: float(i) for i, level in enumerate(levels)})


def standardised(column: str, mean: float, sd: float) -> str:
    return f"(({column} - {number(mean)}) / {number(sd or 1.0)})"


PRODUCT = "driv_age_x_veh_power"


def terms(spec: DesignSpec) -> list[Term]:
    out: list[Term] = []
    for source, (low, high) in spec.splines.items():
        out += [Term(f"{source}_sp_{i}", source, v) for i, v in enumerate(basis(source, low, high, spec.knots))]
    out += [Term(c, c, standardised(c, mean, sd)) for c, (mean, sd) in spec.scaled.items()]
    if spec.area_levels:
        out.append(Term("area", "area", area_rank(spec.area_levels)))
    for source, levels in spec.one_hot.items():
        for level in levels[1:]:
            hit = {known: float(known == level) for known in levels} if level == levels[1] else None
            sql = _by_level(source, hit) if hit else f"CASE WHEN {source} = {_text(level)} THEN 1D ELSE 0D END"
            out.append(Term(f"{source}_{level}", source, sql))
    if spec.interactions:
        out.append(Term(PRODUCT, PRODUCT, "cast(driv_age * veh_power AS double)"))
    return out


def codes(spec: DesignSpec) -> list[str]:
    """SQL of the few numbers of a row from which ``expanded`` makes all terms: the clamped value of a spline source, the
    value of a scaled one, the position of a level. As in ``terms`` an unknown level raises."""
    out = [f"least(greatest(cast({c} AS double), {number(low)}), {number(high)})" for c, (low, high) in spec.splines.items()]
    out += [f"cast({c} AS double)" for c in spec.scaled]
    if spec.area_levels:
        out.append(area_rank(spec.area_levels))
    out += [_by_level(c, {level: float(i) for i, level in enumerate(levels)}) for c, levels in spec.one_hot.items() if len(levels) > 1]
    if spec.interactions:
        out.append("cast(driv_age * veh_power AS double)")
    return out


def expanded(spec: DesignSpec, rows: np.ndarray) -> np.ndarray:
    """The columns of ``terms``, after one of ones, for rows of ``codes``."""
    n, one_hot = len(rows), [levels for levels in spec.one_hot.values() if len(levels) > 1]
    width = (spec.knots + 2) * len(spec.splines) + len(spec.scaled) + bool(spec.area_levels) + spec.interactions
    out = np.zeros((n, 1 + width + sum(len(levels) - 1 for levels in one_hot)))
    out[:, 0] = 1.0
    at, every, columns = 1, np.arange(n), iter(rows.T)
    for low, high in spec.splines.values():
        u = (next(columns) - low) / ((high - low) / (spec.knots - 1))
        interval = np.minimum(np.floor(u), spec.knots - 2).astype(np.intp)
        t = u - interval
        pieces = ((1 - t) ** 3, (3 * t - 6) * t * t + 4, ((3 - 3 * t) * t + 3) * t + 1, t**3)
        for k, piece in enumerate(pieces):
            out[every, at + interval + k] = piece / 6
        at += spec.knots + 2
    for mean, sd in spec.scaled.values():
        out[:, at] = (next(columns) - mean) / (sd or 1.0)
        at += 1
    if spec.area_levels:
        out[:, at] = next(columns)
        at += 1
    for levels in one_hot:
        level = next(columns).astype(np.intp)
        hit = np.flatnonzero(level)
        out[hit, at + level[hit] - 1] = 1.0
        at += len(levels) - 1
    if spec.interactions:
        out[:, at] = next(columns)
    return out


def log_contributions(spec: DesignSpec, coefficients: list[float]) -> dict[str, str]:
    """Source feature -> SQL of sum(beta_j x_j) over its encoded columns.

    Each source collapses to a single expression: a cubic per knot interval, or one value per level.
    """
    out: dict[str, str] = {}
    rest = list(coefficients)

    def take(n: int) -> list[float]:
        taken = rest[:n]
        del rest[:n]
        return taken

    for source, (low, high) in spec.splines.items():
        out[source] = combination(source, low, high, spec.knots, take(spec.knots + 2))
    for source, (mean, sd) in spec.scaled.items():
        out[source] = f"{number(take(1)[0])} * {standardised(source, mean, sd)}"
    if spec.area_levels:
        beta = take(1)[0]
        out["area"] = _by_level("area", {level: beta * i for i, level in enumerate(spec.area_levels)})
    for source, levels in spec.one_hot.items():
        out[source] = _by_level(source, dict(zip(levels, [0.0, *take(len(levels) - 1)])))
    if spec.interactions:
        out[PRODUCT] = f"{number(take(1)[0])} * driv_age * veh_power"
    return out


def fit_design(df: DataFrame, settings: Features, rows: str | None = None) -> DesignSpec:
    """Learn ranges, means and levels in one aggregate. ``rows`` names a row-count column of pre-aggregated input."""
    n = F.col(rows) if rows else F.lit(1)
    aggregates = []
    for c in SPLINE_SOURCES:
        aggregates += [F.min(c).cast("double").alias(f"lo_{c}"), F.max(c).cast("double").alias(f"hi_{c}")]
    for c in SCALED_SOURCES:
        aggregates += [F.sum(F.col(c) * n).alias(f"s1_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    aggregates += [F.sum(n).alias("n"), *[F.approx_count_distinct(c).alias(f"levels_{c}") for c in ONE_HOT_SOURCES]]
    found = df.agg(*aggregates).first()
    # Levels are counted, roughly, before any list of them is made; the exact check below sees lists of that size at most.
    too_many = [c for c in ONE_HOT_SOURCES if found[f"levels_{c}"] > 2 * MAX_LEVELS]
    if too_many:
        raise ValueError(f"too many levels for a rating factor: {too_many}")
    means = {c: found[f"s1_{c}"] / found["n"] for c in SCALED_SOURCES}
    spread = df.agg(
        *[F.sqrt(F.sum(n * (F.col(c) - F.lit(means[c])) * (F.col(c) - F.lit(means[c]))) / F.sum(n)).alias(c) for c in means],
        *[F.collect_set(c).alias(f"set_{c}") for c in ONE_HOT_SOURCES],
    ).first()
    one_hot = {c: sorted(spread[f"set_{c}"]) for c in ONE_HOT_SOURCES}
    too_many = [c for c, levels in one_hot.items() if len(levels) > MAX_LEVELS]
    if too_many:
        raise ValueError(f"too many levels for a rating factor: {too_many}")
    return DesignSpec(
        splines={c: [found[f"lo_{c}"], found[f"hi_{c}"]] for c in SPLINE_SOURCES},
        knots=settings.spline_knots,
        scaled={c: [float(means[c]), float(spread[c])] for c in SCALED_SOURCES},
        area_levels=list(settings.area_levels),
        one_hot=one_hot,
        interactions=settings.interactions,
    )


def one_way_design(df: DataFrame, source: str) -> DesignSpec:
    """A single one-hot factor."""
    levels = sorted(r[0] for r in df.select(source).distinct().limit(MAX_LEVELS + 1).collect())
    if len(levels) > MAX_LEVELS:
        raise ValueError(f"too many levels for a rating factor: {source}")
    return DesignSpec(one_hot={source: levels})


def encode(df: DataFrame, spec: DesignSpec, keep: list[str], only: list[int] | None = None) -> DataFrame:
    """``keep`` columns plus the vector ``features`` of all terms, or of those at the positions ``only``."""
    chosen = terms(spec) if only is None else [terms(spec)[i] for i in only]
    values = F.expr("array(" + ", ".join(t.sql for t in chosen) + ")")
    return df.select(*keep, array_to_vector(values).alias("features"))


def encoded_columns(df: DataFrame, spec: DesignSpec, keep: list[str]) -> DataFrame:
    """One named double column per term."""
    return df.selectExpr(*keep, *[f"{t.sql} AS `{t.name}`" for t in terms(spec)])


def sources_of(spec: DesignSpec) -> list[str]:
    found = [*spec.splines, *spec.scaled]
    if spec.area_levels:
        found.append("area")
    found += list(spec.one_hot)
    if spec.interactions:
        found += [c for c in ("driv_age", "veh_power") if c not in found]
    return found


def design_cells(df: DataFrame, sources: list[str], extra: list[str] | None = None) -> DataFrame:
    """Rows that share all source columns collapsed to one: row count, weight and weighted mean target.

    A log-link GLM sees its target only through these sums, so the fit on cells equals the fit on rows, and every
    iteration and every fit of a grid reads the smaller table. Frequent cells merge map-side.
    """
    weight, target = F.col("sample_weight").cast("double"), F.col("y")
    grouped = df.groupBy(*(extra or []), *sources).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(weight).alias("w"), F.sum(weight * target).alias("wy")
    )
    return grouped.withColumn("y", F.col("wy") / F.col("w")).drop("wy")
