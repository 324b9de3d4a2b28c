"""Batch pricing of a quote table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.operators.drift import psi_from_reference
from premia.operators.glm import FittedGlm
from premia.operators.profile import levels_of
from premia.operators.quality import quote_rules, validate_lenient
from premia.operators.quotes import PricingAssets, price_quotes, quote_features, with_request_id
from premia.plans import runs
from premia.settings import NUMERIC_FEATURES, Settings
from premia.sources.readers import read_table


def pricing_models(models: DataFrame, log: DataFrame, settings: Settings) -> DataFrame:
    """Latest frequency and severity model with start time and data hash of the run that made it."""
    wanted = [settings.pricing.frequency_model, settings.pricing.severity_model]
    latest = runs.model_latest(models.where(F.col("name").isin(*wanted)))
    stamped = log.select("run_id", "started_at", F.try_element_at("tags", F.lit("gold_content_digest")).alias("data_hash"))
    return latest.join(stamped, "run_id", "left")


def load_pricing_assets(
    spark: SparkSession, runs_path: str, silver_path: str, settings: Settings, gold_path: str | None = None
) -> PricingAssets:
    """Latest models, large-loss load and, with ``gold_path``, the reference distribution of the training rows."""
    found = {
        r["name"]: r
        for r in pricing_models(runs.read_models(spark, runs_path), runs.read_runs(spark, runs_path), settings).collect()
    }
    p = settings.pricing
    for name in (p.frequency_model, p.severity_model):
        if name not in found:
            raise RuntimeError(f"no registered version of model {name!r}")
    frequency, severity = found[p.frequency_model], found[p.severity_model]
    load = read_table(spark, f"{silver_path}/large_loss_load").first()["large_loss_load"]
    return PricingAssets(
        FittedGlm.from_json(frequency["model"]),
        FittedGlm.from_json(severity["model"]),
        int(frequency["version"]),
        int(severity["version"]),
        load,
        str(frequency["started_at"]),
        frequency["data_hash"],
        read_table(spark, f"{gold_path}/reference_distribution") if gold_path else None,
    )


def price_table(
    quotes: DataFrame, levels: DataFrame, assets: PricingAssets, settings: Settings
) -> tuple[DataFrame, DataFrame]:
    """(priced, rejected); rejected rows carry the failed rules in ``_reason``."""
    rules = quote_rules(settings, levels_of(levels, "region"), levels_of(levels, "veh_brand"))
    valid, rejected = validate_lenient(quotes, rules)
    return with_request_id(price_quotes(valid, assets, settings)), rejected


def quote_drift(quotes: DataFrame, stored_reference: DataFrame, settings: Settings) -> DataFrame:
    rows = quote_features(quotes, settings)
    return psi_from_reference(stored_reference, rows, list(NUMERIC_FEATURES), settings.monitoring)
