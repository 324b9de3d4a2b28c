"""Cleaning steps of the silver layer. Every step is DataFrame -> DataFrame and lazy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from premia.operators.quantiles import exact_quantiles
from premia.operators.skew import hot_keys, in_place, left_broadcast, salt_of
from premia.settings import Cleaning
from premia.sources.schemas import COVARIATES, SNAKE_NAMES

AMOUNTS = ("total_claim_amount", "capped_claim_amount", "excess_claim_amount", "max_claim_amount")
# The reason and the notes are texts of the output tables.
NO_SEVERITY_REASON = "claim_nb positive but no severity record"


def capped(x: Column, cap) -> Column:
    """Upper clip that leaves null alone (``least`` alone would turn null into the cap)."""
    return F.when(x > F.lit(cap), F.lit(cap)).otherwise(x)


def cap_exposure(df: DataFrame, cap: float) -> DataFrame:
    return df.withColumn("Exposure", capped(F.col("Exposure"), cap))


def cap_claim_nb(df: DataFrame, cap: int) -> DataFrame:
    return df.withColumn("ClaimNb", capped(F.col("ClaimNb"), cap).cast("bigint"))


def group_sizes(df: DataFrame, keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_covariate_duplicates"))


def flag_duplicates(df: DataFrame, keys=COVARIATES, id_column: str = "IDpol") -> DataFrame:
    """Size of each row's covariate group and whether it is shared.

    The rows are exchanged once, by their covariates, and counted where they meet. Hot groups would fill one task: their
    sizes come from a pre-aggregating group-by, are broadcast, and their rows are salted.
    """
    keys = list(keys)
    df = in_place(df)
    hot = hot_group_sizes(df, keys)
    rows = left_broadcast(df, hot.withColumnRenamed("n_covariate_duplicates", "_size"), keys)
    salt = F.when(F.col("_size").isNotNull(), salt_of(df.sparkSession, [id_column])).otherwise(F.lit(0))
    together = W.partitionBy(*keys, "_salt")
    counted = F.coalesce("_size", F.count(F.lit(1)).over(together))
    sized = rows.withColumn("_salt", salt).withColumn("n_covariate_duplicates", counted).drop("_size", "_salt")
    return sized.withColumn("is_duplicate_group", F.col("n_covariate_duplicates") > 1)


def hot_group_sizes(df: DataFrame, keys: list[str]) -> DataFrame:
    """Sizes of the largest groups, bounded as in ``hot_keys``. Hot are hashes of the keys, of which counts are exchanged
    instead of keys; groups of one hash are told apart by their keys, so that every row of a group is hot or none is."""
    code = F.xxhash64(*keys).alias("_code")
    codes = hot_keys(df.select(code), ["_code"])
    return group_sizes(df.withColumn("_code", code).join(F.broadcast(codes), "_code", "left_semi"), keys)


def aggregate_severity(claims: DataFrame) -> DataFrame:
    return claims.groupBy("IDpol").agg(*_severity_totals())


def _severity_totals() -> list[Column]:
    amount = F.col("ClaimAmount")
    return [
        F.sum(amount).alias("total_claim_amount"),
        F.count(amount).alias("n_severity_rows"),
        F.max(amount).alias("max_claim_amount"),
    ]


def large_loss_cap(claims: DataFrame, settings: Cleaning) -> float:
    """The fixed threshold, or the exact quantile of the claim amounts."""
    if settings.large_loss_method == "fixed":
        return settings.large_loss_threshold
    if settings.large_loss_method != "quantile":
        raise ValueError(f"unknown large-loss method {settings.large_loss_method!r}")
    amounts = claims.select(F.lit("ClaimAmount").alias("feature"), F.col("ClaimAmount").alias("value"))
    return exact_quantiles(amounts, [settings.large_loss_quantile]).first()["quantiles"][0]


def with_capped_amounts(claims: DataFrame, settings: Cleaning) -> DataFrame:
    cap, amount = large_loss_cap(claims, settings), F.col("ClaimAmount")
    clipped = claims.withColumn("capped_claim_amount", capped(amount, cap))
    return clipped.withColumn("excess_claim_amount", amount - F.col("capped_claim_amount"))


def _loss_totals() -> list[Column]:
    return [
        F.sum("capped_claim_amount").alias("capped_claim_amount"),
        F.sum("excess_claim_amount").alias("excess_claim_amount"),
    ]


def cap_large_losses(claims: DataFrame, settings: Cleaning) -> DataFrame:
    return with_capped_amounts(claims, settings).groupBy("IDpol").agg(*_loss_totals())


def severity_per_policy(claims: DataFrame, settings: Cleaning) -> DataFrame:
    """Plain and capped totals in a single aggregate, so the policy table is joined only once."""
    return with_capped_amounts(claims, settings).groupBy("IDpol").agg(*_severity_totals(), *_loss_totals())


def join_frequency_severity(policies: DataFrame, severity: DataFrame) -> DataFrame:
    """Left join on the policy id; ``severity`` has one row per id. Amounts are zero-filled only without claims."""
    joined = policies.join(severity, "IDpol", "left").withColumn(
        "has_severity_record", F.col("n_severity_rows").isNotNull()
    )
    filled = {
        c: F.when(F.col("ClaimNb") == 0, F.coalesce(F.col(c), F.lit(0.0))).otherwise(F.col(c)) for c in AMOUNTS
    }
    filled["n_severity_rows"] = F.coalesce(F.col("n_severity_rows"), F.lit(0)).cast("bigint")
    return joined.withColumns(filled).withColumn(
        "claim_count_mismatch", F.col("n_severity_rows") != F.col("ClaimNb")
    )


def rename_snake_case(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(SNAKE_NAMES)


def silver_ratios(df: DataFrame) -> DataFrame:
    claims, exposure, amount = F.col("claim_nb"), F.col("exposure"), F.col("capped_claim_amount")
    return df.withColumns(
        {
            "claim_frequency": claims / exposure,
            "avg_claim_amount": F.when(claims > 0, amount / claims),
            "pure_premium": amount / exposure,
        }
    )


def large_loss_load(df: DataFrame) -> DataFrame:
    """Total excess per exposure year, over all rows including those quarantined afterwards."""
    return df.agg((F.sum("excess_claim_amount") / F.sum("exposure")).alias("large_loss_load"))


def lacks_severity() -> Column:
    return (F.col("claim_nb") > 0) & ~F.col("has_severity_record")


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    kept = df.where(~lacks_severity())
    rejected = df.where(lacks_severity()).withColumn("_reason", F.lit(NO_SEVERITY_REASON))
    return kept, rejected


def step_counters(settings: Cleaning) -> list[Column]:
    """Per-step counts over joined policy rows that still carry the uncapped values as ``_exposure`` and ``_claims``."""
    missing = (F.col("ClaimNb") > 0) & ~F.col("has_severity_record")
    return [
        F.count(F.lit(1)).alias("policies"),
        F.count_if(F.col("_exposure") > settings.exposure_cap).alias("exposure_hits"),
        F.count_if(F.col("_claims") > settings.claim_cap).alias("claim_hits"),
        F.count_if("is_duplicate_group").alias("duplicates"),
        F.count_if(missing).alias("missing"),
    ]


def clean_stats(joined: DataFrame, claims: DataFrame, settings: Cleaning) -> DataFrame:
    """One row per cleaning step in pipeline order, from one aggregate over each of the two tables."""
    cap = large_loss_cap(claims, settings)
    per_policy = claims.groupBy("IDpol").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("ClaimAmount") > cap).alias("hits")
    )
    claim_side = per_policy.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("claims"),
        F.count(F.lit(1)).alias("claim_ids"),
        F.coalesce(F.sum("hits"), F.lit(0)).alias("large"),
    )
    counts = joined.agg(*step_counters(settings)).unionByName(claim_side, allowMissingColumns=True)
    counts = counts.agg(*[F.max(c).alias(c) for c in counts.columns])
    large_note = F.format_string(f"capped %d claims at {cap:.2f} ({settings.large_loss_method})", "large")
    missing_note = F.format_string("%d policies have claims but no severity record", "missing")
    # Step names and notes.
    steps = [
        ("cap_exposure", "policies", "policies", "exposure_hits", F.lit(f"clipped Exposure to {settings.exposure_cap}")),
        ("cap_claim_nb", "policies", "policies", "claim_hits", F.lit(f"clipped ClaimNb to {settings.claim_cap}")),
        ("flag_duplicates", "policies", "policies", "duplicates", F.lit("flagged rows sharing identical covariates")),
        ("aggregate_severity", "claims", "claim_ids", "claims", F.lit("grouped severity rows by IDpol")),
        ("cap_large_losses", "claims", "claim_ids", "large", large_note),
        ("join_frequency_severity", "policies", "policies", "missing", missing_note),
        ("rename_snake_case", "policies", "policies", None, F.lit("renamed columns to snake_case")),
        ("assert_levels", "policies", "policies", None, F.lit("all categorical levels within config")),
    ]
    rows = [
        F.struct(
            F.lit(rank).alias("rank"),
            F.lit(step).alias("step"),
            F.col(rows_in).cast("bigint").alias("rows_in"),
            F.col(rows_out).cast("bigint").alias("rows_out"),
            (F.col(hits) if hits else F.lit(0)).cast("bigint").alias("rows_affected"),
            note.alias("note"),
        )
        for rank, (step, rows_in, rows_out, hits, note) in enumerate(steps, start=1)
    ]
    return counts.select(F.inline(F.array(*rows)))
