"""Quote pricing as one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.operators.explain import with_reason_codes
from premia.operators.features import engineered_columns
from premia.operators.glm import FittedGlm, combine_freq_sev
from premia.settings import Settings
from premia.sources.schemas import QUOTE_FIELDS


@dataclass(frozen=True)
class PricingAssets:
    frequency: FittedGlm
    severity: FittedGlm
    frequency_version: int
    severity_version: int
    large_loss_load: float
    trained_at: str | None = None
    data_hash: str | None = None
    #: Bins of the training rows that quotes are held against for drift.
    reference: DataFrame | None = None

    def version(self) -> str:
        return f"freq:{self.frequency_version}|sev:{self.severity_version}"


def quote_features(quotes: DataFrame, settings: Settings, keep: list[str] | None = None) -> DataFrame:
    return engineered_columns(quotes.select(*(keep or []), *QUOTE_FIELDS), settings.features)


def technical_premium(pure: Column, exposure: Column, load: float, settings: Settings) -> Column:
    p = settings.pricing
    return pure * (1 + p.expense_load) * (1 + p.profit_load) + F.lit(load) * exposure


def price_quotes(quotes: DataFrame, assets: PricingAssets, settings: Settings, keep: list[str] | None = None) -> DataFrame:
    """Premiums, model outputs and reason codes per quote. ``keep`` names further columns to carry along."""
    rows = quote_features(quotes, settings, keep)
    rows = rows.withColumns({"frequency": assets.frequency.prediction(), "severity": assets.severity.prediction()})
    pure = combine_freq_sev(F.col("frequency"), F.col("severity")) * F.col("exposure")
    rows = with_reason_codes(rows.withColumn("premium_pure", pure), assets.frequency, settings.pricing.reason_codes)
    return rows.select(
        *(keep or []),
        "policy_id",
        "premium_pure",
        technical_premium(F.col("premium_pure"), F.col("exposure"), assets.large_loss_load, settings).alias(
            "premium_technical"
        ),
        "frequency",
        "severity",
        F.lit(settings.pricing.currency).alias("currency"),
        F.lit(assets.version()).alias("model_version"),
        "reason_codes",
    )


def with_request_id(priced: DataFrame) -> DataFrame:
    return priced.withColumn("request_id", F.uuid())
