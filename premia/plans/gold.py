"""Gold layer: modelling tables per use case, split and written in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from premia.operators.drift import reference_distribution
from premia.operators.evaluate import split_counts
from premia.operators.features import GOLD_COLUMNS, engineered_columns, rows_for, target_columns
from premia.operators.split import assert_no_leakage, grouped_split
from premia.plans import lineage
from premia.settings import NUMERIC_FEATURES, Settings, Splitting
from premia.sources.readers import read_split, read_table
from premia.sources.sinks import write_by_split, write_table


def gold_table(silver: DataFrame, use_case: str, settings: Settings, splitting: Splitting | None = None) -> DataFrame:
    rows = target_columns(engineered_columns(rows_for(silver, use_case), settings.features), use_case)
    return grouped_split(rows, splitting or settings.splitting).select(*GOLD_COLUMNS)


def build_gold(
    spark: SparkSession, silver_path: str, out_path: str, lineage_path: str, use_case: str, settings: Settings
) -> dict[str, int]:
    """Writes ``out_path/use_case`` by split and returns the split sizes."""
    upstream = lineage.latest_bundle(spark, lineage_path, "silver", required=True)
    silver = read_table(spark, f"{silver_path}/policies")
    target = f"{out_path}/{use_case}"
    write_by_split(gold_table(silver, use_case, settings), target)
    gold = read_table(spark, target)
    assert_no_leakage(gold)
    if use_case == "frequency":
        reference = reference_distribution(
            read_split(spark, target, "train"), list(NUMERIC_FEATURES), settings.monitoring
        )
        write_table(reference, f"{out_path}/reference_distribution")
    splits = {f"{use_case}/{s}": read_split(spark, target, s) for s in ("train", "val", "test")}
    lineage.record(
        spark, lineage_path, f"gold/{use_case}", splits, upstream=upstream, extra={"use_case": use_case}
    )
    return {r["split"]: r["n"] for r in split_counts(gold).collect()}
