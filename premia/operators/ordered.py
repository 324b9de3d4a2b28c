"""Running totals in a global order, without a window that sorts everything in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from premia.functions.bins import edges_below
from premia.operators.quantiles import bucket_count, cut_points
from premia.workspace import stored

#: Rows that one ordered range should hold; the number of ranges follows from it and the size of the input.
TARGET_ROWS = 1_000_000


def _same(df: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join with a small table on keys whose nulls match."""
    renamed = small.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    match = reduce(lambda x, y: x & y, [df[k].eqNullSafe(renamed[f"_k_{k}"]) for k in keys])
    return df.join(F.broadcast(renamed), match, how).drop(*[f"_k_{k}" for k in keys])


def _ranges(df: DataFrame, key: str, tie: str, by: list[str], target_rows: int | None = None) -> DataFrame:
    """Adds (_range, _sub): an even, order-preserving partition of the rows by (key, tie) inside ``by``.

    Cut points of the key split it into ranges; a value that is itself a cut point gets a range of its own. Only such
    a range can be hot (many rows with one key). It is split again along even cut points of the tie column, into as
    many parts as its rows need, so a part holds about the target however many rows share the key.
    """
    rows = df.count()
    n = max(bucket_count(df), -(-rows // (target_rows or TARGET_ROWS)))
    cuts = df.groupBy(*by).agg(cut_points(F.col(key), n).alias("_cuts"), cut_points(F.col(tie), n).alias("_tie_cuts"))
    placed = _same(df, cuts, by)
    # Cut points are distinct, so a key lies at a cut where the next one equals it: one search for both.
    placed = placed.withColumn("_below", edges_below(F.col("_cuts"), F.col(key), n))
    at_cut = F.coalesce(F.get("_cuts", F.col("_below")) == F.col(key), F.lit(False)).cast("int")
    placed = placed.withColumn("_range", 2 * F.col("_below") + at_cut).drop("_below")

    parts = F.ceil(F.count(F.lit(1)) / F.lit(max(1, -(-rows // n)))).alias("_parts")
    hot = placed.where(F.col("_range") % 2 == 1).groupBy(*by, "_range").agg(parts).where("_parts > 1")
    placed = _same(placed, hot, [*by, "_range"], "left")
    position = edges_below(F.col("_tie_cuts"), F.col(tie), n)
    sub = F.floor(position * F.col("_parts") / (F.size("_tie_cuts") + 1)).cast("int")
    return placed.withColumn("_sub", F.coalesce(sub, F.lit(0))).drop("_cuts", "_tie_cuts", "_parts")


def prefix_sum(
    df: DataFrame, key: str, tie: str, measures: dict[str, Column], by: list[str] | None = None
) -> DataFrame:
    """Inclusive running totals of ``measures`` in ascending (key, tie) order, plus ``<name>_total`` over all rows.

    Rows are placed into ordered ranges, range totals are accumulated over that small table, and the running total
    inside a range is a window partitioned by range. Each total carries the type of its measure's sum, so decimal
    measures give sums that do not depend on task order. ``by`` must name few groups, such as the curves of a chart:
    the range totals (about three for each target-sized range and group) are broadcast. A null in ``by`` is a group like
    any other. Hand in narrow rows: they are stored once, because cut points, range totals and the final window each
    read them; measures follow from the stored columns.
    """
    by = by or ["_all"]
    source = df.withColumn("_all", F.lit(0)) if by == ["_all"] else df
    placed = _ranges(stored(source, "ordered"), key, tie, by).withColumns({f"_m_{m}": c for m, c in measures.items()})

    sizes = placed.groupBy(*by, "_range", "_sub").agg(*[F.sum(f"_m_{m}").alias(f"_s_{m}") for m in measures])
    before = W.partitionBy(*by).orderBy("_range", "_sub").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    offsets = sizes.select(
        *by,
        "_range",
        "_sub",
        *[F.sum(f"_s_{m}").over(before).alias(f"_o_{m}") for m in measures],
        *[F.sum(f"_s_{m}").over(whole).alias(f"{m}_total") for m in measures],
    )
    inside = W.partitionBy(*by, "_range", "_sub").orderBy(key, tie).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = _same(placed, offsets, [*by, "_range", "_sub"])
    out = out.withColumns(
        {
            m: F.sum(f"_m_{m}").over(inside) + F.coalesce(F.col(f"_o_{m}"), F.lit(0))
            for m in measures
        }
    )
    helper = ["_range", "_sub", "_all"] + [f"_o_{m}" for m in measures] + [f"_m_{m}" for m in measures]
    return out.drop(*helper)
