"""Named row checks: strict (raise), lenient (quarantine with reasons) and as violation counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.operators.skew import salted_lookup
from premia.settings import Settings


@dataclass(frozen=True)
class Check:
    """``test`` is true for a good value; null values are left to ``not_nullable``. ``reason`` names the rule."""

    column: str
    reason: str
    test: Column

    def failed(self) -> Column:
        return ~F.coalesce(self.test, F.lit(True))


@dataclass(frozen=True)
class TableRules:
    columns: dict[str, str]
    checks: tuple[Check, ...]
    unique: str | None = None


class ValidationError(ValueError):
    pass


def _number(x) -> str:
    return str(int(x)) if float(x).is_integer() and not isinstance(x, float) else str(x)


def at_least(column: str, bound) -> Check:
    return Check(column, f"greater_than_or_equal_to({_number(bound)})", F.col(column) >= F.lit(bound))


def above(column: str, bound) -> Check:
    return Check(column, f"greater_than({_number(bound)})", F.col(column) > F.lit(bound))


def between(column: str, low, high) -> Check:
    return Check(column, f"in_range({_number(low)}, {_number(high)})", F.col(column).between(low, high))


def between_open_low(column: str, low, high) -> Check:
    test = (F.col(column) > F.lit(low)) & (F.col(column) <= F.lit(high))
    return Check(column, f"in_range({_number(low)}, {_number(high)})", test)


def one_of(column: str, levels) -> Check:
    return Check(column, f"isin({list(levels)})", F.col(column).isin(*levels))


def not_null(column: str) -> Check:
    return Check(column, "not_nullable", F.col(column).isNotNull())


UNIQUE_REASON = "field_uniqueness"


def bronze_policy_rules(settings: Settings) -> TableRules:
    kinds = {
        "IDpol": "bigint", "ClaimNb": "bigint", "Exposure": "double", "Area": "string", "VehPower": "bigint",
        "VehAge": "bigint", "DrivAge": "bigint", "BonusMalus": "bigint", "VehBrand": "string", "VehGas": "string",
        "Density": "double", "Region": "string",
    }
    checks = (
        at_least("ClaimNb", 0),
        above("Exposure", 0),
        one_of("Area", settings.features.area_levels),
        between("DrivAge", 18, 100),
        between("BonusMalus", 50, 350),
        one_of("VehGas", settings.features.fuel_levels),
        *[not_null(c) for c in kinds],
    )
    return TableRules(kinds, checks, unique="IDpol")


def bronze_claim_rules(settings: Settings) -> TableRules:
    kinds = {"IDpol": "bigint", "ClaimAmount": "double"}
    checks = (at_least("ClaimAmount", settings.cleaning.min_claim_amount), *[not_null(c) for c in kinds])
    return TableRules(kinds, checks)


def silver_rules(settings: Settings) -> TableRules:
    kinds = {
        "policy_id": "bigint", "claim_nb": "bigint", "exposure": "double", "area": "string", "driv_age": "bigint",
        "bonus_malus": "bigint", "veh_gas": "string",
    }
    checks = (
        at_least("claim_nb", 0),
        between_open_low("exposure", 0, settings.cleaning.exposure_cap),
        one_of("area", settings.features.area_levels),
        between("driv_age", 18, 100),
        between("bonus_malus", 50, 350),
        one_of("veh_gas", settings.features.fuel_levels),
        *[not_null(c) for c in kinds],
    )
    return TableRules(kinds, checks, unique="policy_id")


def quote_rules(settings: Settings, region_levels, brand_levels) -> TableRules:
    """Quote rules; the region and brand levels are the short lists taken from the bronze tables."""
    kinds = {
        "policy_id": "bigint", "exposure": "double", "area": "string", "veh_power": "bigint", "veh_age": "bigint",
        "driv_age": "bigint", "bonus_malus": "bigint", "veh_brand": "string", "veh_gas": "string",
        "density": "double", "region": "string",
    }
    checks = (
        between_open_low("exposure", 0, settings.pricing.max_quote_exposure),
        at_least("veh_power", 1),
        at_least("veh_age", 0),
        between("driv_age", 18, 100),
        between("bonus_malus", 50, 350),
        above("density", 0),
        one_of("area", settings.features.area_levels),
        one_of("veh_gas", settings.features.fuel_levels),
        one_of("region", region_levels),
        one_of("veh_brand", brand_levels),
        *[not_null(c) for c in kinds],
    )
    return TableRules(kinds, checks)


def check_layout(df: DataFrame, rules: TableRules) -> None:
    """Missing columns and wrong types are errors in both modes; further columns are allowed."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wrong = [f"{c}: {found.get(c, 'missing')} instead of {k}" for c, k in rules.columns.items() if found.get(c) != k]
    if wrong:
        raise ValidationError("; ".join(wrong))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, copies) for keys on more than one row."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def rows_with_duplicate_key(df: DataFrame, key: str, spread_by: list[str]) -> DataFrame:
    """Every row of every duplicate group."""
    return salted_lookup(df, duplicate_keys(df, key), [key], spread_by, how="inner", rows="copies").drop("copies")


def violation_counts(df: DataFrame, rules: TableRules) -> DataFrame:
    """(column, reason, violations) for every check: one aggregate over the rows, one over the key."""
    counted = df.agg(*[F.count_if(c.failed()).alias(f"c{i}") for i, c in enumerate(rules.checks)])
    rows = [
        F.struct(F.lit(c.column).alias("column"), F.lit(c.reason).alias("reason"), F.col(f"c{i}").alias("violations"))
        for i, c in enumerate(rules.checks)
    ]
    out = counted.select(F.inline(F.array(*rows)))
    if rules.unique:
        copies = duplicate_keys(df.where(F.col(rules.unique).isNotNull()), rules.unique)
        out = out.unionByName(
            copies.agg(F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("violations")).select(
                F.lit(rules.unique).alias("column"), F.lit(UNIQUE_REASON).alias("reason"), "violations"
            )
        )
    return out


def validate_strict(df: DataFrame, rules: TableRules) -> DataFrame:
    """Returns the input when every check holds, else raises with the violated checks and their counts."""
    check_layout(df, rules)
    bad = violation_counts(df, rules).where("violations > 0").collect()
    if bad:
        raise ValidationError("; ".join(f"{r['column']}: {r['reason']} fails on {r['violations']} rows" for r in bad))
    return df


def with_reasons(df: DataFrame, rules: TableRules) -> DataFrame:
    """Adds ``_reason``: the sorted distinct names of the failed checks, empty for a good row."""
    check_layout(df, rules)
    failed: dict[str, Column] = {}
    for check in rules.checks:
        failed[check.reason] = failed[check.reason] | check.failed() if check.reason in failed else check.failed()
    source = df
    if rules.unique:
        others = [c for c in rules.columns if c != rules.unique]
        keys = duplicate_keys(df.where(F.col(rules.unique).isNotNull()), rules.unique)
        source = salted_lookup(df, keys, [rules.unique], others or [rules.unique], rows="copies")
        failed[UNIQUE_REASON] = F.col("copies").isNotNull()
    named = [F.when(failed[reason], F.lit(reason)) for reason in sorted(failed)]
    return source.withColumn("_reason", F.concat_ws(", ", *named)).drop("copies")


def validate_lenient(df: DataFrame, rules: TableRules) -> tuple[DataFrame, DataFrame]:
    judged = with_reasons(df, rules)
    return judged.where("_reason = ''").drop("_reason"), judged.where("_reason <> ''")


def level_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct (feature, level) of the given string columns, in one pass."""
    return df.select(*columns).unpivot([], columns, "feature", "level").distinct()


def unknown_levels(df: DataFrame, levels: DataFrame) -> DataFrame:
    """(feature, level) pairs of the data that the level table does not list.

    The distinct pairs are computed first; the level table holds the allowed values of a few rating factors.
    """
    features = ["area", "veh_gas", "region", "veh_brand"]
    return level_pairs(df, features).join(levels, ["feature", "level"], "left_anti")


def assert_levels(df: DataFrame, levels: DataFrame) -> DataFrame:
    """Raises with every (feature, level) that the level table lacks; these are few, as rating factors have few levels."""
    unknown = unknown_levels(df, levels).orderBy("feature", "level").collect()
    if unknown:
        raise ValueError("unseen levels: " + ", ".join(f"{r['feature']}={r['level']!r}" for r in unknown))
    return df


def without_claims(df: DataFrame) -> DataFrame:
    return df.where("claim_nb <= 0")


def claims_only(df: DataFrame) -> DataFrame:
    return df.where("claim_nb > 0")


def assert_claims_only(df: DataFrame) -> None:
    if not without_claims(df).isEmpty():
        raise ValueError("the severity model needs claim_nb > 0 on every row")
