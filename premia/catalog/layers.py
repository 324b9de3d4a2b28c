"""The stored layers that queries start from, built once per session and input folder."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.operators import cleaning
from premia.operators.drift import reference_distribution
from premia.operators.features import scored
from premia.plans import bronze, silver
from premia.plans.gold import gold_table
from premia.settings import NUMERIC_FEATURES, Settings
from premia.sources import adapter
from premia.workspace import fresh_path, stored

SETTINGS = Settings()
INGESTED_AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
SOURCE = "derived"

_built: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = make()
    return _built[key]


def bronze_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_policies(adapter.policies(spark, sf_dir), INGESTED_AT, SOURCE)


def bronze_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_claims(adapter.claims(spark, sf_dir), INGESTED_AT, SOURCE)


def stored_policies(spark, sf_dir) -> DataFrame:
    return _once(spark, sf_dir, "policies", lambda: stored(bronze_policies(spark, sf_dir), "bronze-policies"))


def stored_claims(spark, sf_dir) -> DataFrame:
    return _once(spark, sf_dir, "claims", lambda: stored(bronze_claims(spark, sf_dir), "bronze-claims"))


def joined(spark, sf_dir) -> DataFrame:
    def make():
        rows = silver.joined_policies(stored_policies(spark, sf_dir), stored_claims(spark, sf_dir), SETTINGS)
        return stored(rows, "silver-joined")

    return _once(spark, sf_dir, "joined", make)


def all_policies(spark, sf_dir) -> DataFrame:
    rows = joined(spark, sf_dir).drop("_exposure", "_claims")
    return cleaning.silver_ratios(cleaning.rename_snake_case(rows))


def silver_policies(spark, sf_dir) -> DataFrame:
    """A filter over the stored joined rows, which therefore are not written a second time."""
    return cleaning.split_quarantine(all_policies(spark, sf_dir))[0]


def gold(spark, sf_dir, use_case: str) -> DataFrame:
    def make():
        rows = gold_table(silver_policies(spark, sf_dir), use_case, SETTINGS)
        path = fresh_path(spark, f"gold-{use_case}")
        rows.write.mode("overwrite").partitionBy("split").parquet(path)
        return spark.read.parquet(path)

    return _once(spark, sf_dir, f"gold-{use_case}", make)


def split_of(spark, sf_dir, use_case: str, split: str) -> DataFrame:
    return gold(spark, sf_dir, use_case).where(F.col("split") == split)


# Fixed predictors for the evaluation queries: sums and products only, so every engine computes the same bits.
PREDICTORS = {
    "frequency": "cast(0.05 AS double) + cast(0.002 AS double) * bonus_malus + cast(0.001 AS double) * driv_age",
    "severity": "cast(15000 + 20 * driv_age - 10 * veh_age AS double)",
    "pure_premium": "cast(40 * bonus_malus + 30 * driv_age + 5 * veh_power AS double)",
}


def evaluation_rows(spark, sf_dir, use_case: str, split: str | None = None) -> DataFrame:
    """policy_id, y, yhat, w of all rows, as the predictors are fixed and no row has been learned from; or of a split."""
    rows = gold(spark, sf_dir, use_case) if split is None else split_of(spark, sf_dir, use_case, split)
    return scored(rows, F.expr(PREDICTORS[use_case]))


def evaluation_rows_with(spark, sf_dir, use_case: str, columns: list[str]) -> DataFrame:
    rows = gold(spark, sf_dir, use_case)
    return rows.select(
        "policy_id",
        "y",
        F.expr(PREDICTORS[use_case]).alias("yhat"),
        F.col("sample_weight").cast("double").alias("w"),
        *columns,
    )


def reference(spark, sf_dir) -> DataFrame:
    def make():
        rows = reference_distribution(
            split_of(spark, sf_dir, "frequency", "train"), list(NUMERIC_FEATURES), SETTINGS.monitoring
        )
        return stored(rows, "reference-distribution")

    return _once(spark, sf_dir, "reference", make)


def quotes(spark, sf_dir) -> DataFrame:
    """Columns of the stored policies: the joins behind them run once for policies and quotes."""
    return adapter.quotes(stored_policies(spark, sf_dir))
