"""Modelling columns derived from silver policies or quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.functions.bins import band
from premia.functions.hashing import fold_of
from premia.settings import CATEGORICAL_FEATURES, NUMERIC_FEATURES, USE_CASES, Features

GOLD_COLUMNS = (
    "policy_id",
    "exposure",
    "split",
    *NUMERIC_FEATURES,
    *CATEGORICAL_FEATURES,
    "is_new_vehicle",
    "claim_nb",
    "y",
    "sample_weight",
)


def engineered_columns(df: DataFrame, settings: Features) -> DataFrame:
    return df.withColumns(
        {
            "log_density": F.log("density"),
            "driv_age_band": band(F.col("driv_age"), settings.driver_age_bins),
            "veh_age_band": band(F.col("veh_age"), settings.vehicle_age_bins),
            "veh_power_band": band(F.col("veh_power"), settings.vehicle_power_bins),
            "is_new_vehicle": (F.col("veh_age") <= 1).cast("bigint"),
        }
    )


def rows_for(df: DataFrame, use_case: str) -> DataFrame:
    if use_case not in USE_CASES:
        raise ValueError(f"unknown use case {use_case!r}")
    return df.where("claim_nb > 0") if use_case == "severity" else df


def target_columns(df: DataFrame, use_case: str) -> DataFrame:
    """``y`` and ``sample_weight`` of the use case."""
    targets = {
        "frequency": (F.col("claim_nb") / F.col("exposure"), F.col("exposure")),
        "severity": (F.col("avg_claim_amount"), F.col("claim_nb")),
        "pure_premium": (F.col("pure_premium"), F.col("exposure")),
    }
    y, weight = targets[use_case]
    return df.withColumns({"y": y, "sample_weight": weight})


def kfold_assign(df: DataFrame, folds: int, id_column: str = "policy_id") -> DataFrame:
    """All rows of an id share a fold."""
    return df.withColumn("fold", fold_of(F.col(id_column), folds))


def scored(df: DataFrame, yhat) -> DataFrame:
    """Narrow evaluation rows: policy_id, y, yhat, w."""
    return df.select("policy_id", "y", yhat.alias("yhat"), F.col("sample_weight").cast("double").alias("w"))
