"""Actuarial evaluation of predictions. Inputs are rows with an id, target ``y``, prediction ``yhat``, weight ``w``."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.functions.deviance import mean_deviance, weighted_mean
from premia.operators.ordered import prefix_sum

#: Digits behind the point of accumulated weights whose largest is one or more; smaller weights get more.
DIGITS = 10


def exact_type(df: DataFrame, column: str = "w") -> str:
    """A decimal type in which weights of this size keep about ten significant digits and sums do not overflow."""
    most = df.agg(F.max(F.abs(F.col(column)))).first()[0]
    digits = DIGITS - min(0, math.floor(math.log10(most))) if most else DIGITS
    return f"decimal(38,{min(digits, 37)})"


def deviance(df: DataFrame, kind: str, power: float | None = None) -> DataFrame:
    value = mean_deviance(kind, F.col("y"), F.col("yhat"), F.col("w"), power)
    return df.agg(value.alias("deviance"))


def deviance_explained(df: DataFrame, baseline: str, kind: str, power: float | None = None) -> DataFrame:
    """1 - D(model) / D(baseline), both deviances from one aggregate."""
    y, w = F.col("y"), F.col("w")
    model = mean_deviance(kind, y, F.col("yhat"), w, power)
    base = mean_deviance(kind, y, F.col(baseline), w, power)
    return df.agg((1 - model / base).alias("deviance_explained"))


def balance_check(df: DataFrame) -> DataFrame:
    return df.agg((F.sum(F.col("yhat") * F.col("w")) / F.sum(F.col("y") * F.col("w"))).alias("balance"))


def weighted_bins(df: DataFrame, n_bins: int, tie: str = "policy_id") -> DataFrame:
    """Bin 0 .. n_bins-1 by share of cumulative weight, ascending prediction.

    Weights are accumulated as decimals: a row on a bin border lands in the same bin whatever the task order.
    """
    running = prefix_sum(df, "yhat", tie, {"cum_w": F.col("w").cast(exact_type(df))})
    share = F.col("cum_w").cast("double") / F.col("cum_w_total").cast("double")
    position = F.least(F.floor(share * F.lit(float(n_bins))), F.lit(n_bins - 1))
    return running.withColumn("bin", position.cast("int")).drop("cum_w", "cum_w_total")


def lift_table(df: DataFrame, n_bins: int = 10, tie: str = "policy_id") -> DataFrame:
    binned = weighted_bins(df, n_bins, tie)
    table = binned.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("w").alias("exposure"),
        weighted_mean(F.col("yhat"), F.col("w")).alias("mean_pred"),
        weighted_mean(F.col("y"), F.col("w")).alias("mean_actual"),
    )
    return table.withColumn("ratio", F.col("mean_actual") / F.col("mean_pred"))


def calibration_table(df: DataFrame, n_bins: int = 20, tie: str = "policy_id") -> DataFrame:
    return lift_table(df, n_bins, tie)


def diagonal_bounds(table: DataFrame) -> DataFrame:
    """Lowest and highest mean of a calibration table, the ends of its diagonal."""
    return table.agg(
        F.least(F.min("mean_pred"), F.min("mean_actual")).alias("low"),
        F.greatest(F.max("mean_pred"), F.max("mean_actual")).alias("high"),
    )


def _lorenz_steps(df: DataFrame, order_by: str, tie: str, by: list[str] | None) -> DataFrame:
    weight, loss = F.col("w"), F.col("y") * F.col("w")
    return prefix_sum(df, order_by, tie, {"cum_w": weight, "cum_y": loss}, by)


def lorenz_curve(df: DataFrame, points: int | None = None, tie: str = "policy_id", by: list[str] | None = None):
    """(cum_w, cum_y) shares in prediction order with the origin; ``by`` gives one curve per group.

    With ``points`` the curve is thinned to the last row of each of that many equal weight steps, for drawing.
    """
    steps = _lorenz_steps(df, "yhat", tie, by)
    keys = by or []
    curve = steps.select(
        *keys,
        tie,
        "yhat",
        (F.col("cum_w") / F.col("cum_w_total")).alias("cum_w"),
        (F.col("cum_y") / F.col("cum_y_total")).alias("cum_y"),
    )
    if points is not None:
        slot = F.ceil(F.col("cum_w") * F.lit(points) - F.lit(1e-9)).alias("slot")
        last = F.max(F.struct("cum_w", "cum_y")).alias("p")
        curve = curve.groupBy(*keys, slot).agg(last).select(*keys, "p.cum_w", "p.cum_y")
    else:
        curve = curve.select(*keys, "cum_w", "cum_y")
    origin = curve.select(*keys).distinct() if keys else df.select(F.lit(0)).limit(1).drop("0")
    origin = origin.select(*keys, F.lit(0.0).alias("cum_w"), F.lit(0.0).alias("cum_y"))
    return curve.unionByName(origin)


def _gini_value() -> Column:
    """1 - 2 x trapezoid area; each row contributes its own width times the mean of its two heights."""
    width = F.col("w") / F.col("cum_w_total")
    own = F.col("y") * F.col("w") / F.col("cum_y_total")
    height = (2 * F.col("cum_y") / F.col("cum_y_total") - own) / 2
    return 1 - 2 * F.sum(width * height)


def lorenz_gini(df: DataFrame, order_by: str, tie: str = "policy_id", by: list[str] | None = None) -> DataFrame:
    steps = _lorenz_steps(df, order_by, tie, by)
    return steps.groupBy(*(by or [])).agg(_gini_value().alias("gini"))


def normalized_gini(df: DataFrame, tie: str = "policy_id") -> DataFrame:
    """Gini in prediction order over Gini in target order; both orders run as one job over a doubled narrow table."""
    narrow = df.select(tie, "y", "w", F.explode(F.create_map(F.lit("model"), "yhat", F.lit("perfect"), "y")))
    both = narrow.withColumnsRenamed({"key": "curve", "value": "_order"})
    ginis = lorenz_gini(both, "_order", tie, by=["curve"])
    model = F.max(F.when(F.col("curve") == "model", F.col("gini")))
    perfect = F.max(F.when(F.col("curve") == "perfect", F.col("gini")))
    return ginis.agg(
        model.alias("model_gini"), perfect.alias("perfect_gini"), (model / perfect).alias("normalized_gini")
    )


def segment_ae(df: DataFrame, by: list[str]) -> DataFrame:
    """Actual against expected per value of each segment column, all columns in one pass; null values are left out."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("segment"), F.col(c).cast("string").alias("segment_value")) for c in by])
    )
    long = df.select("y", "yhat", "w", pairs.alias("s")).select("y", "yhat", "w", "s.*")
    table = (
        long.where(F.col("segment_value").isNotNull())
        .groupBy("segment", "segment_value")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("w").alias("exposure"),
            weighted_mean(F.col("y"), F.col("w")).alias("mean_actual"),
            weighted_mean(F.col("yhat"), F.col("w")).alias("mean_pred"),
        )
    )
    return table.withColumn("ae_ratio", F.col("mean_actual") / F.col("mean_pred"))


def actual_vs_expected(df: DataFrame, by: list[str]) -> DataFrame:
    return segment_ae(df, by)


def segment_bar_widths(table: DataFrame) -> DataFrame:
    """Exposure of each bar relative to the widest bar of its segment. The table has one row per segment value."""
    widest = table.groupBy("segment").agg(F.max("exposure").alias("_widest"))
    return table.join(F.broadcast(widest), "segment").withColumn("width", F.col("exposure") / F.col("_widest")).drop(
        "_widest"
    )


def metrics_long(runs: DataFrame, id_column: str, metrics: list[str]) -> DataFrame:
    return runs.unpivot([id_column], metrics, "metric", "value")


def stability_report(runs: DataFrame, id_column: str, metrics: list[str]) -> DataFrame:
    """Mean and sample standard deviation of each metric over runs."""
    return (
        metrics_long(runs, id_column, metrics)
        .groupBy("metric")
        .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    )


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def claim_rate_by_split(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.avg((F.col("claim_nb") > 0).cast("double")).alias("claim_rate"))
