"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.workspace import stored

#: Hot keys for each shuffle partition; a key that is not among them has at most an eighth of an even partition.
HOT_KEYS_PER_PARTITION = 8


def _limit(facts: DataFrame, limit: int | None) -> int:
    return limit or HOT_KEYS_PER_PARTITION * int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def most_frequent(counts: DataFrame, keys: list[str], rows: str, limit: int) -> DataFrame:
    """The ``limit`` keys with the largest ``rows``; equal counts are taken in key order, so every evaluation of the
    plan finds the same keys."""
    return counts.where(F.col(rows) > 1).orderBy(F.desc(rows), *keys).limit(limit).select(*keys)


def hot_keys(facts: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    """The ``limit`` most frequent keys, by default a few per shuffle partition. Every key with at least 1/limit of the
    rows is among them, and the table has at most ``limit`` rows, so it may be broadcast."""
    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return most_frequent(counts, keys, "_rows", _limit(facts, limit))


#: Plan nodes below which a task that runs again reads the same rows in the same order: files and what stays in place.
_IN_PLACE = {"Project", "Filter", "Relation", "RelationV2", "Range", "LocalRelation"}


def in_place(df: DataFrame) -> DataFrame:
    """``df`` with rows whose places are the same whenever a task runs again. A plan that moves rows between tasks may
    deliver them in another order after an executor is lost; such a plan is written once and read back."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    nodes = {re.split(r"[ \[(]", line.lstrip(" :+-"), maxsplit=1)[0] for line in plan.splitlines() if line.strip()}
    return df if nodes <= _IN_PLACE else stored(df, "facts")


def _same(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def left_broadcast(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the other columns of ``small`` (few rows, one per key); null keys match null keys."""
    renamed = small.withColumnsRenamed({k: f"_b_{k}" for k in keys})
    match = _same(rows, renamed, [(k, f"_b_{k}") for k in keys])
    return rows.join(F.broadcast(renamed), match, "left").drop(*[f"_b_{k}" for k in keys])


def salt_of(spark, spread_by: list[str], salts: int | None = None) -> Column:
    """A sub-key from a hash of ``spread_by`` and of the row's place in the input (see ``in_place``)."""
    n = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return F.pmod(F.xxhash64(*spread_by, F.monotonically_increasing_id()), F.lit(n)).cast("int")


def salted_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "left",
    salts: int | None = None,
    rows: str | None = None,
) -> DataFrame:
    """Join ``facts`` with ``lookup`` (one row per key) on ``keys``; null keys match null keys.

    Rows of hot keys are spread over ``salts`` sub-keys by a hash of ``spread_by`` and of their place in the input, so
    that rows that are equal in every column are spread, too; ``in_place`` keeps these places when tasks run again. The
    matching lookup rows are repeated once per sub-key, so no task receives a whole hot group. Cold keys are joined
    unchanged. ``rows`` names a column of the lookup that holds the number of facts per key; without it they are counted.
    """
    facts = in_place(facts)
    spark = facts.sparkSession
    n = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = most_frequent(lookup, keys, rows, _limit(facts, None)) if rows else hot_keys(facts, keys)
    hot = found.withColumn("_hot", F.lit(True))
    hot_f = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_hot")

    left = facts.join(F.broadcast(hot_f), _same(facts, hot_f, [(k, f"_h_{k}") for k in keys]), "left")
    left = left.withColumn(
        "_salt",
        F.when(F.col("_hot"), salt_of(spark, spread_by, n)).otherwise(F.lit(0)),
    ).drop("_hot", *[f"_h_{k}" for k in keys])

    renamed = lookup.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    hot_l = hot.select(*[F.col(k).alias(f"_g_{k}") for k in keys], "_hot")
    right = renamed.join(F.broadcast(hot_l), _same(renamed, hot_l, [(f"_k_{k}", f"_g_{k}") for k in keys]), "left")
    right = right.withColumn(
        "_salt_r",
        F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))),
    ).drop("_hot", *[f"_g_{k}" for k in keys])

    pairs = [(k, f"_k_{k}") for k in keys] + [("_salt", "_salt_r")]
    return left.join(right, _same(left, right, pairs), how).drop("_salt", "_salt_r", *[f"_k_{k}" for k in keys])
