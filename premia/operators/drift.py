"""Population stability index, live and against stored reference bins, for many features in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.functions.bins import edges_up_to, inner
from premia.operators.quantiles import quantiles_of_counts, value_counts
from premia.settings import Monitoring
from premia.workspace import stored


def long_features(df: DataFrame, features: list[str]) -> DataFrame:
    return df.select(*[F.col(f).cast("double").alias(f) for f in features]).unpivot([], features, "feature", "value")


def _shares(settings: Monitoring) -> list[float]:
    step = 1 / settings.bins
    return [i * step for i in range(settings.bins)] + [1.0]


def _quantile_table(counts: DataFrame, settings: Monitoring) -> DataFrame:
    """(feature, quantiles) as a local table: one row of bins + 1 numbers per monitored feature."""
    rows = quantiles_of_counts(counts, _shares(settings)).select("feature", "quantiles").collect()
    return counts.sparkSession.createDataFrame(rows, "feature string, quantiles array<double>")


def _bin_counts(counts: DataFrame, bins: DataFrame, name: str, most_bins: int) -> DataFrame:
    """Rows per (feature, bin) of (feature, value, rows). ``bins`` has one row per feature and is broadcast; values
    below the first or above the last inner edge belong to the outer bins. No feature has more than ``most_bins``."""
    position = edges_up_to(F.col("inner_edges"), F.col("value"), max(most_bins, 1))
    placed = counts.join(F.broadcast(bins.select("feature", "inner_edges")), "feature")
    return placed.groupBy("feature", position.alias("bin")).agg(F.sum("rows").alias(name))


def _each_row(long: DataFrame) -> DataFrame:
    """Rows of (feature, value) as counts of one: binned before the shuffle, so that only bins are exchanged."""
    return long.where(F.col("value").isNotNull()).withColumn("rows", F.lit(1).cast("bigint"))


def status(score: Column, settings: Monitoring) -> Column:
    return (
        F.when(score >= settings.alert, "alert").when(score >= settings.watch, "watch").otherwise("stable")
    )


def _score(grid: DataFrame, settings: Monitoring) -> DataFrame:
    """PSI per feature from (feature, bin, ref_rows, cur_rows, ref_n, cur_n), every bin present. A feature without any
    current value has the least share in every bin, so its disappearance shows."""
    floor = F.lit(settings.epsilon)
    ref = F.greatest(F.coalesce("ref_rows", F.lit(0)) / F.col("ref_n"), floor)
    cur = F.greatest(F.coalesce("cur_rows", F.lit(0)) / F.col("cur_n"), floor)
    part = F.when(F.col("bin").isNotNull(), (cur - ref) * F.log(cur / ref)).otherwise(F.lit(0.0))
    scored = grid.groupBy("feature").agg(F.sum(part).alias("psi"))
    return scored.withColumn("status", status(F.col("psi"), settings))


def _grid(bins: DataFrame) -> DataFrame:
    """One row per (feature, bin), also for bins that no row falls into."""
    last = F.col("n_bins") - 1
    listed = F.when(F.col("n_bins") > 0, F.sequence(F.lit(0), last))
    return bins.select("feature", F.explode_outer(listed).alias("bin"))


def psi_report(reference: DataFrame, current: DataFrame, features: list[str], settings: Monitoring) -> DataFrame:
    """(feature, psi, status). Bin edges are the distinct deciles of the reference."""
    ref_counts = stored(value_counts(long_features(reference, features)), "reference-counts")
    cur_counts = _each_row(long_features(current, features))
    edges = _quantile_table(ref_counts, settings).withColumn("edges", F.array_distinct("quantiles"))
    bins = edges.select(
        "feature", inner(F.col("edges")).alias("inner_edges"), (F.size("edges") - 1).alias("n_bins")
    )
    ref, cur = (_bin_counts(c, bins, n, settings.bins) for c, n in ((ref_counts, "ref_rows"), (cur_counts, "cur_rows")))
    return _compare(bins, ref, cur, settings)


def _compare(bins: DataFrame, ref: DataFrame, cur: DataFrame, settings: Monitoring) -> DataFrame:
    ref_n = ref.groupBy("feature").agg(F.sum("ref_rows").alias("ref_n"))
    cur_n = cur.groupBy("feature").agg(F.sum("cur_rows").alias("cur_n"))
    grid = (
        _grid(bins)
        .join(ref, ["feature", "bin"], "left")
        .join(cur, ["feature", "bin"], "left")
        .join(ref_n, "feature", "left")
        .join(cur_n, "feature", "left")
    )
    return _score(grid, settings)


def prediction_drift(reference: DataFrame, current: DataFrame, settings: Monitoring, column: str = "yhat"):
    return psi_report(reference, current, [column], settings)


def reference_distribution(df: DataFrame, features: list[str], settings: Monitoring) -> DataFrame:
    """(feature, bin_edges, bin_counts); edges may repeat, the last bin is closed."""
    counts = stored(value_counts(long_features(df, features)), "reference-counts")
    edges = _quantile_table(counts, settings).withColumnRenamed("quantiles", "bin_edges")
    bins = edges.select("feature", "bin_edges", inner(F.col("bin_edges")).alias("inner_edges"))
    filled = _bin_counts(counts, bins, "rows", settings.bins)
    per_bin = filled.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("bin", "rows"))).alias("at"))
    listed = F.transform(
        F.sequence(F.lit(0), F.lit(settings.bins - 1)),
        lambda i: F.coalesce(F.try_element_at(F.col("at"), i), F.lit(0)).cast("bigint"),
    )
    return edges.join(per_bin, "feature").select("feature", "bin_edges", listed.alias("bin_counts"))


def psi_from_reference(stored: DataFrame, current: DataFrame, features: list[str], settings: Monitoring) -> DataFrame:
    """PSI of ``current`` against stored bins; the table of stored bins has one row per feature."""
    return psi_from_long(stored, long_features(current, features), settings)


def psi_from_long(stored_bins: DataFrame, long: DataFrame, settings: Monitoring) -> DataFrame:
    return psi_from_counts(stored_bins, _each_row(long), settings)


def psi_from_counts(stored_bins: DataFrame, counts: DataFrame, settings: Monitoring) -> DataFrame:
    """From (feature, value, rows)."""
    return psi_from_bins(stored_bins, counts_in_bins(stored_bins, counts), settings)


def _stored_edges(stored_bins: DataFrame) -> DataFrame:
    return stored_bins.select("feature", inner(F.col("bin_edges")).alias("inner_edges"), (F.size("bin_edges") - 1).alias("n_bins"))


def counts_in_bins(stored_bins: DataFrame, counts: DataFrame, *by: str) -> DataFrame:
    """Rows per (feature, bin and the columns of ``by``) of (feature, value, rows, ...): at most features x bins rows for
    each combination of these, whatever the number of values. A value that is null has no bin, nor has a feature that
    the reference lacks."""
    bins = _stored_edges(stored_bins)
    most = bins.agg(F.max("n_bins")).first()[0] or 1
    position = edges_up_to(F.col("inner_edges"), F.col("value"), most)
    placed = counts.where(F.col("value").isNotNull()).join(F.broadcast(bins.select("feature", "inner_edges")), "feature")
    return placed.groupBy("feature", position.alias("bin"), *by).agg(F.sum("rows").alias("rows"))


def psi_from_bins(stored_bins: DataFrame, counts: DataFrame, settings: Monitoring) -> DataFrame:
    """From (feature, bin, rows) in the stored bins, for example the state of ``start_bin_counts``."""
    ref = stored_bins.select("feature", F.posexplode("bin_counts").alias("bin", "ref_rows"))
    cur = counts.groupBy("feature", "bin").agg(F.sum("rows").alias("cur_rows"))
    return _compare(_stored_edges(stored_bins), ref, cur, settings)


# Chart colour per status.
STATUS_COLOURS = {"stable": "tab:green", "watch": "tab:orange", "alert": "tab:red"}


def psi_bars(report: DataFrame) -> DataFrame:
    colours = F.create_map(*[F.lit(x) for pair in STATUS_COLOURS.items() for x in pair])
    return report.withColumn("colour", F.element_at(colours, F.col("status")))
