"""Multiplicative contributions of a log-link GLM and reason codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.operators.design import PRODUCT, log_contributions
from premia.operators.glm import FittedGlm


def contribution_columns(model: FittedGlm) -> dict[str, Column]:
    """Source feature -> exp(sum of beta_j x_j over its encoded columns); the intercept is left out."""
    logs = log_contributions(model.design, model.coefficients)
    return {source: F.exp(F.expr(sql)) for source, sql in logs.items()}


def _shown(source: str) -> str:
    return "cast(NULL AS string)" if source == PRODUCT else f"cast({source} AS string)"


def glm_contributions(df: DataFrame, model: FittedGlm, keep: list[str]) -> DataFrame:
    """One row per input row and source feature: feature, value, factor."""
    logs = log_contributions(model.design, model.coefficients)
    entries = [f"struct('{s}' AS feature, {_shown(s)} AS value, exp({sql}) AS factor)" for s, sql in logs.items()]
    return df.selectExpr(*keep, f"inline(array({', '.join(entries)}))")


def with_reason_codes(df: DataFrame, model: FittedGlm, k: int, name: str = "reason_codes") -> DataFrame:
    """Adds an array of the k features with the largest |ln factor|: feature, value, factor, direction.

    The few features are sorted inside the row, so nothing is shuffled. Expressions without lambdas are used because
    those stay inside generated code.
    """
    logs = log_contributions(model.design, model.coefficients)
    logged = df.selectExpr("*", *[f"{sql} AS `_log_{s}`" for s, sql in logs.items()])
    entries = [
        f"struct(-abs(`_log_{s}`) AS strength, '{s}' AS feature, {_shown(s)} AS value, exp(`_log_{s}`) AS factor)"
        for s in logs
    ]
    ranked = logged.withColumn("_ranked", F.expr(f"slice(sort_array(array({', '.join(entries)})), 1, {k})"))
    codes = [
        f"struct(_ranked[{i}].feature AS feature, _ranked[{i}].value AS value, _ranked[{i}].factor AS factor, "
        f"CASE WHEN _ranked[{i}].factor > 1 THEN 'increases' ELSE 'decreases' END AS direction)"
        for i in range(min(k, len(logs)))
    ]
    coded = ranked.withColumn(name, F.expr(f"array({', '.join(codes)})"))
    return coded.drop("_ranked", *[f"_log_{s}" for s in logs])


def spline_effect(grid: DataFrame, model: FittedGlm, feature: str) -> DataFrame:
    """(x, effect) for a grid of feature values."""
    source = grid.withColumn(feature, F.col("x"))
    return source.select("x", contribution_columns(model)[feature].alias("effect"))


def value_grid(df: DataFrame, feature: str, points: int) -> DataFrame:
    """``points`` even values between the smallest and largest value of a column."""
    ends = df.agg(F.min(feature).cast("double").alias("low"), F.max(feature).cast("double").alias("high"))
    step = (F.col("high") - F.col("low")) / F.lit(points - 1)
    listed = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.col("low") + i * step)
    return ends.select(F.explode(listed).alias("x"))
