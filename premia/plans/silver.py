"""Silver layer: capping, duplicate flags, the policy-claim join, ratios and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.operators import cleaning
from premia.operators.quality import (
    assert_levels,
    bronze_claim_rules,
    bronze_policy_rules,
    silver_rules,
    validate_strict,
)
from premia.plans import lineage
from premia.settings import Settings
from premia.sources.readers import read_table
from premia.sources.sinks import write_table
from premia.workspace import fresh_path


def joined_policies(policies: DataFrame, claims: DataFrame, settings: Settings) -> DataFrame:
    """Capped and flagged policies with their severity totals, raw column names, plus the uncapped values."""
    rules = settings.cleaning
    # Capped columns are no covariates, so the rows are flagged first and exchanged without them.
    flagged = cleaning.flag_duplicates(policies)
    kept = flagged.withColumns({"_exposure": F.col("Exposure"), "_claims": F.col("ClaimNb")})
    capped = cleaning.cap_claim_nb(cleaning.cap_exposure(kept, rules.exposure_cap), rules.claim_cap)
    return cleaning.join_frequency_severity(capped, cleaning.severity_per_policy(claims, rules))


def all_policies(policies: DataFrame, claims: DataFrame, settings: Settings) -> DataFrame:
    """Every policy in silver form, before the quarantine split."""
    joined = joined_policies(policies, claims, settings).drop("_exposure", "_claims")
    return cleaning.silver_ratios(cleaning.rename_snake_case(joined))


def silver_tables(policies: DataFrame, claims: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    return cleaning.split_quarantine(all_policies(policies, claims, settings))


def build_silver(
    spark: SparkSession, bronze_path: str, out_path: str, lineage_path: str, settings: Settings
) -> tuple[int, int]:
    """Writes policies, quarantine, statistics and the large-loss load; returns (kept, quarantined) row counts.

    The joined rows are stored once; statistics, load, level check and both outputs read that table.
    """
    upstream = lineage.latest_bundle(spark, lineage_path, "bronze", required=True)
    policies = validate_strict(read_table(spark, f"{bronze_path}/policies"), bronze_policy_rules(settings))
    claims = validate_strict(read_table(spark, f"{bronze_path}/claims"), bronze_claim_rules(settings))
    staged = fresh_path(spark, "silver-joined")
    write_table(joined_policies(policies, claims, settings), staged)
    joined = read_table(spark, staged)

    stats = cleaning.clean_stats(joined, claims, settings.cleaning)
    write_table(stats, f"{out_path}/clean_stats")
    renamed = cleaning.rename_snake_case(joined.drop("_exposure", "_claims"))
    assert_levels(renamed, read_table(spark, f"{bronze_path}/levels"))
    silver = cleaning.silver_ratios(renamed)
    write_table(cleaning.large_loss_load(silver), f"{out_path}/large_loss_load")
    kept, rejected = cleaning.split_quarantine(silver)
    write_table(kept, f"{out_path}/policies")
    write_table(rejected, f"{out_path}/quarantine")

    tables = {n: read_table(spark, f"{out_path}/{n}") for n in ("policies", "quarantine")}
    validate_strict(tables["policies"], silver_rules(settings))
    lineage.record(
        spark,
        lineage_path,
        "silver",
        tables,
        upstream=upstream,
        extra={
            "large_loss_cap": cleaning.large_loss_cap(claims, settings.cleaning),
            "large_loss_load": read_table(spark, f"{out_path}/large_loss_load").first()["large_loss_load"],
            "quarantine_rows": tables["quarantine"].count(),
            "clean_stats": [r.asDict() for r in read_table(spark, f"{out_path}/clean_stats").collect()],
        },
    )
    return tables["policies"].count(), tables["quarantine"].count()
