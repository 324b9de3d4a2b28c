"""Column profiles and level lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premia.operators.quality import level_pairs
from premia.settings import Settings

#: Levels that one rule may list; they become part of an expression.
MAX_RULE_LEVELS = 2000


def profile_columns(df: DataFrame) -> DataFrame:
    """Per column: dtype, distinct values, nulls, numeric range, most frequent value and its share of all rows.

    Values of all columns are counted in one pass; each column is then summed up from its (value, rows) pairs, which
    Spark merges map-side, so neither a frequent value nor a wide column lands in one task. The most frequent value
    is the first in text order among equals.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    counts = texts.unpivot([], df.columns, "column", "value").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("rows")
    )
    value, rows = F.col("value"), F.col("rows")
    number = F.when(F.col("column").isin(*numeric), F.expr("try_cast(value AS double)"))
    most = F.max(F.when(value.isNotNull(), rows))
    summed = counts.groupBy("column").agg(
        F.count(value).alias("n_unique"),
        F.sum("rows").alias("n_rows"),
        F.coalesce(F.sum(F.when(value.isNull(), rows)), F.lit(0)).alias("n_null"),
        F.min(number).alias("min"),
        F.max(number).alias("max"),
        F.min(F.when(value.isNotNull(), F.struct((-rows).alias("k"), value.alias("v")))).alias("top"),
        F.coalesce(most, F.lit(0)).alias("top_rows"),
    )
    dtype = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return summed.select(
        "column",
        F.element_at(dtype, F.col("column")).alias("dtype"),
        "n_unique",
        (F.col("n_unique") / F.col("n_rows")).alias("cardinality_ratio"),
        "n_null",
        "min",
        "max",
        F.col("top.v").alias("top_value"),
        (F.col("top_rows") / F.col("n_rows")).alias("top_value_share"),
    )


def feature_levels(bronze_policies: DataFrame, settings: Settings) -> DataFrame:
    """(feature, level): the values seen for region and brand, and the configured ones for area and fuel."""
    seen = level_pairs(
        bronze_policies.select(F.col("Region").alias("region"), F.col("VehBrand").alias("veh_brand")),
        ["region", "veh_brand"],
    ).where(F.col("level").isNotNull())
    configured = [("area", v) for v in settings.features.area_levels]
    configured += [("veh_gas", v) for v in settings.features.fuel_levels]
    fixed = bronze_policies.sparkSession.createDataFrame(configured, "feature string, level string")
    return seen.unionByName(fixed)


def sorted_levels(levels: DataFrame) -> DataFrame:
    """One sorted list per feature; the lists are the short level lists of rating factors."""
    return levels.groupBy("feature").agg(F.sort_array(F.collect_set("level")).alias("levels"))


def levels_of(levels: DataFrame, feature: str) -> list[str]:
    """The sorted levels of one rating factor, for rules that list them; more than ``MAX_RULE_LEVELS`` are an error that
    is found without fetching them all."""
    found = [r["level"] for r in levels.where(F.col("feature") == feature).select("level").distinct().limit(MAX_RULE_LEVELS + 1).collect()]
    if len(found) > MAX_RULE_LEVELS:
        raise ValueError(f"{feature} has more than {MAX_RULE_LEVELS} levels; that is no rating factor")
    return sorted(found)
