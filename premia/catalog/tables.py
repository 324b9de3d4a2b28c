"""Queries for sources, sinks, lineage, quality, cleaning and joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.catalog import layers
from premia.catalog.registry import query, rounded
from premia.operators import cleaning, profile, quality, split
from premia.operators.digest import LIMBS, PRIME, content_digest, digest_state, finished, merged, portable_digest
from premia.plans import bronze, lineage, runs, silver
from premia.settings import Cleaning
from premia.sources import adapter, digests, readers, sinks
from premia.sources.schemas import RAW_POLICY_FIELDS
from premia.workspace import fresh_path

S = layers.SETTINGS
POLICY_COLUMNS = [name for name, _ in RAW_POLICY_FIELDS]


def _raw(spark, sf):
    """Raw tables as files, the way a job finds them."""
    root = fresh_path(spark, "raw")
    sinks.write_table(adapter.policies(spark, sf), f"{root}/policies")
    sinks.write_table(adapter.claims(spark, sf), f"{root}/claims")
    return root


@query(
    "scan_raw",
    """SELECT 'policies' AS table_name, count(*) AS n, round(sum(Exposure), 4) AS total FROM raw_freq
       UNION ALL SELECT 'claims', count(*), round(sum(ClaimAmount), 2) FROM raw_sev""",
)
def scan_raw(spark, sf):
    root = _raw(spark, sf)
    parts = []
    for name, column, digits in (("policies", "Exposure", 4), ("claims", "ClaimAmount", 2)):
        df = readers.read_table(spark, f"{root}/{name}")
        total = F.round(F.sum(column), digits)
        parts.append(df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), total.alias("total")))
    return parts[0].unionByName(parts[1])


@query(
    "scan_layer",
    "SELECT policy_id, claim_nb, area, region FROM gold_f WHERE split = 'train'",
)
def scan_layer(spark, sf):
    return layers.split_of(spark, sf, "frequency", "train").select("policy_id", "claim_nb", "area", "region")


@query(
    "bronze_freq",
    "SELECT *, '2024-01-01 00:00:00' AS _ingested_at, 'derived' AS _source_hash FROM freq",
)
def bronze_freq(spark, sf):
    return layers.bronze_policies(spark, sf).withColumn("_ingested_at", F.col("_ingested_at").cast("string"))


@query(
    "bronze_sev",
    "SELECT IDpol, ClaimAmount, '2024-01-01 00:00:00' AS _ingested_at, 'derived' AS _source_hash FROM sev",
)
def bronze_sev(spark, sf):
    return layers.bronze_claims(spark, sf).withColumn("_ingested_at", F.col("_ingested_at").cast("string"))


@query("bronze_build")
def bronze_build(spark, sf):
    raw, out = _raw(spark, sf), fresh_path(spark, "bronze")
    bronze.build_bronze(spark, raw, out, f"{out}/lineage", S)
    return lineage.read_lineage(spark, f"{out}/lineage").select("layer", "table_name", "rows", "cols", "bundle")


LEVELS_SQL = """SELECT DISTINCT 'region' AS feature, Region AS level FROM freq
    UNION ALL SELECT DISTINCT 'veh_brand', VehBrand FROM freq
    UNION ALL SELECT 'area', unnest(['A','B','C','D','E','F'])
    UNION ALL SELECT 'veh_gas', unnest(['Regular','Diesel'])"""


@query("feature_levels", LEVELS_SQL)
def feature_levels(spark, sf):
    return profile.feature_levels(layers.stored_policies(spark, sf), S)


@query(
    "sorted_levels",
    f"SELECT feature, array_to_string(list_sort(list(level)), ',') AS levels FROM ({LEVELS_SQL}) GROUP BY feature",
)
def sorted_levels(spark, sf):
    levels = profile.sorted_levels(profile.feature_levels(layers.stored_policies(spark, sf), S))
    return levels.withColumn("levels", F.array_join("levels", ","))


@query(
    "sink_quarantine",
    """SELECT policy_id, claim_nb, round(exposure, 6) AS exposure, 'claim_nb positive but no severity record' AS _reason
       FROM quarantine""",
)
def sink_quarantine(spark, sf):
    _, rejected = cleaning.split_quarantine(layers.all_policies(spark, sf))
    path = fresh_path(spark, "quarantine")
    sinks.write_table(rejected, path)
    return rounded(readers.read_table(spark, path).select("policy_id", "claim_nb", "exposure", "_reason"), 6, "exposure")


@query("sink_gold_by_split", "SELECT split, count(*) AS n, sum(claim_nb)::BIGINT AS claims FROM gold_p GROUP BY split")
def sink_gold_by_split(spark, sf):
    path = fresh_path(spark, "by-split")
    sinks.write_by_split(layers.gold(spark, sf, "pure_premium"), path)
    parts = [readers.read_split(spark, path, s).withColumn("split", F.lit(s)) for s in ("train", "val", "test")]
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("claim_nb").alias("claims"))


# Columns of each table that every engine prints alike.
DIGEST_COLUMNS = {
    "raw": {"freq": ["ClaimNb", "Area", "VehPower", "Region"], "sev": ["IDpol"]},
    "silver": {"silver": ["policy_id", "claim_nb", "area", "region"], "quarantine": ["policy_id", "claim_nb"]},
    "gold": {"gold_s": ["policy_id", "claim_nb", "split"]},
}


def _digest_sql(layer: str, table: str, columns: list[str]) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    return f"""SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS rows, {len(columns)} AS cols,
        sha256(CAST(count(*) AS VARCHAR) || ':' || CAST(sum(h) AS VARCHAR) || ':' || CAST(bit_xor(h) AS VARCHAR))
          AS content_digest
        FROM (SELECT CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) AS h FROM {table})"""


DIGESTS_SQL = " UNION ALL ".join(
    _digest_sql(layer, t, cols) for layer, tables in DIGEST_COLUMNS.items() for t, cols in tables.items()
)
MANIFEST_SQL = f"""SELECT *, sha256(array_to_string(list_sort(list(content_digest) OVER (PARTITION BY layer)), ''))
    AS bundle FROM ({DIGESTS_SQL})"""
LINEAGE_SQL = f"""WITH manifest AS ({MANIFEST_SQL}), bundles AS (SELECT DISTINCT layer, bundle FROM manifest)
    SELECT layer, bundle, CASE layer WHEN 'silver' THEN (SELECT bundle FROM bundles WHERE layer = 'raw')
                                     WHEN 'gold' THEN (SELECT bundle FROM bundles WHERE layer = 'silver') END AS upstream
    FROM bundles"""


def _portable_manifest(spark, sf):
    kept, rejected = cleaning.split_quarantine(layers.all_policies(spark, sf))
    tables = {
        "freq": layers.stored_policies(spark, sf),
        "sev": layers.stored_claims(spark, sf),
        "silver": kept,
        "quarantine": rejected,
        "gold_s": layers.gold(spark, sf, "severity"),
    }
    entries = []
    for layer, listed in DIGEST_COLUMNS.items():
        for name, columns in listed.items():
            entry = lineage.table_entry(name, tables[name].select(*columns), portable_digest(tables[name], columns))
            entries.append(entry.withColumn("layer", F.lit(layer)).withColumn("cols", F.lit(len(columns))))
    return lineage.with_bundle(reduce(DataFrame.unionByName, entries))


def _lineage_table(spark, sf):
    """Two writes per layer in a stored lineage table; the first writes carry outdated bundles."""
    path = fresh_path(spark, "lineage")
    manifest = _portable_manifest(spark, sf)
    bundle = {r["layer"]: r["bundle"] for r in manifest.select("layer", "bundle").distinct().collect()}
    parent = F.create_map(F.lit("silver"), F.lit(bundle["raw"]), F.lit("gold"), F.lit(bundle["silver"]))
    rows = manifest.select(
        "layer",
        "table_name",
        F.col("rows").cast("bigint"),
        F.col("cols").cast("int"),
        "table_schema",
        "content_digest",
        "bundle",
        F.try_element_at(parent, F.col("layer")).alias("upstream"),
        F.lit(None).cast("string").alias("extra"),
        F.lit("2024-01-02 00:00:00").cast("timestamp").alias("created_at"),
    )
    older = rows.withColumns(
        {"bundle": F.lit("outdated"), "created_at": F.lit("2024-01-01 00:00:00").cast("timestamp")}
    )
    lineage.append(spark, path, older)
    lineage.append(spark, path, rows)
    return lineage.read_lineage(spark, path)


@query("lineage_manifest", MANIFEST_SQL)
def lineage_manifest(spark, sf):
    return _portable_manifest(spark, sf).select("layer", "table_name", "rows", "cols", "content_digest", "bundle")


@query("lineage_read", LINEAGE_SQL)
def lineage_read(spark, sf):
    return lineage.bundles(_lineage_table(spark, sf)).drop("created_at")


@query("lineage_check", f"SELECT layer, upstream, true AS linked FROM ({LINEAGE_SQL})")
def lineage_check(spark, sf):
    return lineage.lineage_check(_lineage_table(spark, sf))


@query("content_digest")
def digest(spark, sf):
    return content_digest(layers.stored_policies(spark, sf))


def _merged_digest_sql(table: str, columns: list[str]) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    limbs = [f"sum(CAST('0x' || substr(h, {8 * i + 1}, 8) AS HUGEINT)) % {PRIME} AS s{i}" for i in range(LIMBS)]
    joined = " || ':' || ".join(f"CAST(s{i} AS VARCHAR)" for i in range(LIMBS))
    return f"""SELECT rows, {len(columns)} AS cols, sha256(CAST(rows AS VARCHAR) || ':' || {joined}) AS content_digest
        FROM (SELECT count(*) AS rows, {", ".join(limbs)} FROM (SELECT sha256({text}) AS h FROM {table}))"""


@query("content_digest_merged", _merged_digest_sql("freq", DIGEST_COLUMNS["raw"]["freq"]))
def digest_merged(spark, sf):
    """The digest of all policies from the digests of their parts by area."""
    columns = DIGEST_COLUMNS["raw"]["freq"]
    rows = layers.stored_policies(spark, sf)
    urban = F.coalesce(F.col("Area") >= "D", F.lit(False))
    return finished(merged(*[digest_state(rows.where(part), columns) for part in (urban, ~urban)]))


@query("portable_digest", _digest_sql("raw", "freq", DIGEST_COLUMNS["raw"]["freq"]).replace("'raw' AS layer, 'freq' AS table_name,", ""))
def digest_portable(spark, sf):
    columns = DIGEST_COLUMNS["raw"]["freq"]
    return portable_digest(layers.stored_policies(spark, sf), columns).withColumn("cols", F.lit(len(columns)))


@query("file_digest")
def file_digest(spark, sf):
    return digests.file_digests(spark, _raw(spark, sf))


@query("file_tree_digest")
def file_tree_digest(spark, sf):
    return digests.tree_digests(spark, _raw(spark, sf))


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf):
    return readers.read_table(spark, f"{sf}/lineitem.parquet").agg(F.count(F.lit(1)).alias("n"))


def _split_runs(spark, sf):
    """One run row per split with metrics measured on it."""
    rows = layers.gold(spark, sf, "frequency").withColumn("yhat", F.expr(layers.PREDICTORS["frequency"]))
    weight = F.col("sample_weight")
    measured = rows.groupBy("split").agg(
        (F.sum(F.col("yhat") * weight) / F.sum(F.col("y") * weight)).alias("balance"),
        F.sum("claim_nb").cast("double").alias("claims"),
    )
    return measured.select(
        F.col("split").alias("run_id"),
        F.create_map(F.lit("balance"), F.round("balance", 6), F.lit("claims"), F.col("claims")).alias("metrics"),
    )


@query("run_log_append")
def run_log_append(spark, sf):
    path = fresh_path(spark, "runs")
    for row in _split_runs(spark, sf).collect():
        runs.run_log_append(
            spark, path, row["run_id"], {"predictor": "fixed"}, row["metrics"], {}, "{}", register_as="fixed"
        )
    log = runs.read_runs(spark, path).select("run_name", F.explode("metrics").alias("metric", "value"))
    last = runs.model_latest(runs.read_models(spark, path)).select("name", "version")
    versions = {r["name"]: r["version"] for r in last.collect()}
    return log.withColumn("latest_version", F.lit(versions["fixed"]))


@query(
    "run_log_metrics",
    """WITH r AS (SELECT split, CAST(0.05 AS DOUBLE) + CAST(0.002 AS DOUBLE) * bonus_malus
                           + CAST(0.001 AS DOUBLE) * driv_age AS yhat, y, w, claim_nb FROM gold_f),
       m AS (SELECT split AS run_id, round(sum(yhat * w) / sum(y * w), 6) AS balance,
                    CAST(sum(claim_nb) AS DOUBLE) AS claims FROM r GROUP BY split)
       SELECT run_id, 'balance' AS metric, balance AS value FROM m
       UNION ALL SELECT run_id, 'claims', claims FROM m""",
)
def run_log_metrics(spark, sf):
    return runs.run_log_metrics(_split_runs(spark, sf))


def _model_versions(spark, sf):
    """A model table derived from the portfolio: one version per fuel and driver age."""
    rows = layers.silver_policies(spark, sf)
    return rows.groupBy(F.col("veh_gas").alias("name"), F.col("driv_age").cast("string").alias("version")).agg(
        F.concat(F.lit("run-"), F.max("policy_id").cast("string")).alias("run_id"),
        F.sum("claim_nb").cast("string").alias("model"),
    )


@query(
    "model_latest",
    """SELECT veh_gas AS name, CAST(driv_age AS VARCHAR) AS version, 'run-' || CAST(max(policy_id) AS VARCHAR) AS run_id,
              CAST(CAST(sum(claim_nb) AS BIGINT) AS VARCHAR) AS model
       FROM silver GROUP BY veh_gas, driv_age
       QUALIFY driv_age = max(driv_age) OVER (PARTITION BY veh_gas)""",
)
def model_latest(spark, sf):
    return runs.model_latest(_model_versions(spark, sf))


@query(
    "large_loss_load_sink",
    "SELECT round(sum(excess_claim_amount) / sum(exposure), 6) AS large_loss_load FROM silver_all",
)
def large_loss_load_sink(spark, sf):
    path = fresh_path(spark, "large-loss-load")
    sinks.write_table(cleaning.large_loss_load(layers.all_policies(spark, sf)), path)
    return rounded(readers.read_table(spark, path), 6, "large_loss_load")


def _profile_sql() -> str:
    kinds = dict(RAW_POLICY_FIELDS)
    parts = []
    for c, kind in kinds.items():
        number = f"min(CAST({c} AS DOUBLE)), max(CAST({c} AS DOUBLE))" if kind != "string" else "NULL::DOUBLE, NULL::DOUBLE"
        top = f"(SELECT CAST({c} AS VARCHAR) AS v FROM freq GROUP BY {c} ORDER BY count(*) DESC, v LIMIT 1)"
        top_rows = f"(SELECT count(*) AS n FROM freq GROUP BY {c} ORDER BY n DESC LIMIT 1)"
        parts.append(
            f"""SELECT '{c}' AS "column", '{kind}' AS dtype, count(DISTINCT {c}) AS n_unique,
            round(count(DISTINCT {c}) / count(*), 9) AS cardinality_ratio, count(*) - count({c}) AS n_null, {number},
            {top} AS top_value, round({top_rows} / count(*), 9) AS top_value_share FROM freq"""
        )
    first = parts[0].replace("min(CAST(IDpol AS DOUBLE))", "min(CAST(IDpol AS DOUBLE)) AS min", 1)
    first = first.replace("max(CAST(IDpol AS DOUBLE))", "max(CAST(IDpol AS DOUBLE)) AS max", 1)
    return " UNION ALL ".join([first, *parts[1:]])


@query("profile_columns", _profile_sql())
def profile_columns(spark, sf):
    table = profile.profile_columns(layers.stored_policies(spark, sf).select(*POLICY_COLUMNS))
    return rounded(table, 9, "cardinality_ratio", "top_value_share")


def _faulty(spark, sf):
    raw = adapter.faulty_policies(spark, sf)
    return raw.select(*[F.col(c).cast(k).alias(c) for c, k in RAW_POLICY_FIELDS])


def _policy_violations_sql(source: str) -> str:
    nulls = " ".join(
        f"""UNION ALL SELECT '{c}', 'not_nullable', count(*) FILTER (WHERE {c} IS NULL) FROM {source}"""
        for c in POLICY_COLUMNS
    )
    return f"""SELECT 'ClaimNb' AS "column", 'greater_than_or_equal_to(0)' AS reason,
                      count(*) FILTER (WHERE ClaimNb < 0) AS violations FROM {source}
        UNION ALL SELECT 'Exposure', 'greater_than(0)', count(*) FILTER (WHERE Exposure <= 0) FROM {source}
        UNION ALL SELECT 'Area', 'isin([''A'', ''B'', ''C'', ''D'', ''E'', ''F''])',
                         count(*) FILTER (WHERE Area NOT IN ('A','B','C','D','E','F')) FROM {source}
        UNION ALL SELECT 'DrivAge', 'in_range(18, 100)', count(*) FILTER (WHERE DrivAge NOT BETWEEN 18 AND 100) FROM {source}
        UNION ALL SELECT 'BonusMalus', 'in_range(50, 350)',
                         count(*) FILTER (WHERE BonusMalus NOT BETWEEN 50 AND 350) FROM {source}
        UNION ALL SELECT 'VehGas', 'isin([''Regular'', ''Diesel''])',
                         count(*) FILTER (WHERE VehGas NOT IN ('Regular','Diesel')) FROM {source}
        {nulls}
        UNION ALL SELECT 'IDpol', 'field_uniqueness', coalesce(sum(n), 0)::BIGINT
                  FROM (SELECT count(*) AS n FROM {source} GROUP BY IDpol HAVING count(*) > 1)"""


@query("validate_bronze_freq", _policy_violations_sql("faulty"))
def validate_bronze_freq(spark, sf):
    return quality.violation_counts(_faulty(spark, sf), quality.bronze_policy_rules(S))


CLAIM_VIOLATIONS_SQL = """SELECT 'ClaimAmount' AS "column", 'greater_than_or_equal_to(1.0)' AS reason,
           count(*) FILTER (WHERE ClaimAmount < 1) AS violations FROM sev
    UNION ALL SELECT 'IDpol', 'not_nullable', count(*) FILTER (WHERE IDpol IS NULL) FROM sev
    UNION ALL SELECT 'ClaimAmount', 'not_nullable', count(*) FILTER (WHERE ClaimAmount IS NULL) FROM sev"""


@query("validate_bronze_sev", CLAIM_VIOLATIONS_SQL)
def validate_bronze_sev(spark, sf):
    return quality.violation_counts(layers.stored_claims(spark, sf), quality.bronze_claim_rules(S))


@query("validate_job", "SELECT 'policies' AS table_name, count(*) AS rows FROM freq UNION ALL SELECT 'claims', count(*) FROM sev")
def validate_job(spark, sf):
    """Both stored bronze tables held against all of their rules, and their row counts."""
    root = fresh_path(spark, "validate-job")
    sinks.write_table(layers.stored_policies(spark, sf), f"{root}/policies")
    sinks.write_table(layers.stored_claims(spark, sf), f"{root}/claims")
    return bronze.validate_bronze(spark, root, S)


SILVER_NULLS = " ".join(
    f"UNION ALL SELECT '{c}', 'not_nullable', count(*) FILTER (WHERE {c} IS NULL) FROM silver"
    for c in ("policy_id", "claim_nb", "exposure", "area", "driv_age", "bonus_malus", "veh_gas")
)


@query(
    "validate_silver",
    f"""SELECT 'claim_nb' AS "column", 'greater_than_or_equal_to(0)' AS reason,
              count(*) FILTER (WHERE claim_nb < 0) AS violations FROM silver
        UNION ALL SELECT 'exposure', 'in_range(0, 1.0)', count(*) FILTER (WHERE exposure <= 0 OR exposure > 1) FROM silver
        UNION ALL SELECT 'area', 'isin([''A'', ''B'', ''C'', ''D'', ''E'', ''F''])',
                         count(*) FILTER (WHERE area NOT IN ('A','B','C','D','E','F')) FROM silver
        UNION ALL SELECT 'driv_age', 'in_range(18, 100)', count(*) FILTER (WHERE driv_age NOT BETWEEN 18 AND 100) FROM silver
        UNION ALL SELECT 'bonus_malus', 'in_range(50, 350)',
                         count(*) FILTER (WHERE bonus_malus NOT BETWEEN 50 AND 350) FROM silver
        UNION ALL SELECT 'veh_gas', 'isin([''Regular'', ''Diesel''])',
                         count(*) FILTER (WHERE veh_gas NOT IN ('Regular','Diesel')) FROM silver
        {SILVER_NULLS}
        UNION ALL SELECT 'policy_id', 'field_uniqueness', coalesce(sum(n), 0)::BIGINT
                  FROM (SELECT count(*) AS n FROM silver GROUP BY policy_id HAVING count(*) > 1)""",
)
def validate_silver(spark, sf):
    return quality.violation_counts(layers.silver_policies(spark, sf), quality.silver_rules(S))


@query(
    "validate_strict",
    "SELECT 'policies' AS table_name, count(*) AS n FROM freq UNION ALL SELECT 'claims', count(*) FROM sev",
)
def validate_strict(spark, sf):
    policies = quality.validate_strict(layers.stored_policies(spark, sf), quality.bronze_policy_rules(S))
    claims = quality.validate_strict(layers.stored_claims(spark, sf), quality.bronze_claim_rules(S))
    return policies.agg(F.lit("policies").alias("table_name"), F.count(F.lit(1)).alias("n")).unionByName(
        claims.agg(F.lit("claims").alias("table_name"), F.count(F.lit(1)).alias("n"))
    )


@query(
    "validate_lenient",
    "SELECT IDpol, ClaimNb, Area, DrivAge, Region, array_to_string(reasons, ', ') AS _reason FROM faulty_reasons",
)
def validate_lenient(spark, sf):
    valid, bad = quality.validate_lenient(_faulty(spark, sf), quality.bronze_policy_rules(S))
    both = valid.withColumn("_reason", F.lit("")).unionByName(bad)
    return both.select("IDpol", "ClaimNb", "Area", "DrivAge", "Region", "_reason")


@query(
    "join_quarantine_semi",
    "SELECT IDpol, Area FROM faulty_reasons WHERE len(reasons) > 0",
)
def join_quarantine_semi(spark, sf):
    _, bad = quality.validate_lenient(_faulty(spark, sf), quality.bronze_policy_rules(S))
    return bad.select("IDpol", "Area")


@query(
    "check_unique",
    "SELECT IDpol, ClaimNb, VehPower FROM faulty QUALIFY count(*) OVER (PARTITION BY IDpol) > 1",
)
def check_unique(spark, sf):
    rows = quality.rows_with_duplicate_key(_faulty(spark, sf), "IDpol", ["ClaimNb", "VehPower"])
    return rows.select("IDpol", "ClaimNb", "VehPower")


def _faulty_snake(spark, sf):
    return cleaning.rename_snake_case(_faulty(spark, sf).where("Region IS NOT NULL"))


@query("assert_levels", "SELECT DISTINCT 'area' AS feature, Area AS level FROM faulty WHERE Area = 'Z'")
def assert_levels(spark, sf):
    levels = profile.feature_levels(layers.stored_policies(spark, sf), S)
    quality.assert_levels(cleaning.rename_snake_case(layers.stored_policies(spark, sf)), levels)
    return quality.unknown_levels(_faulty_snake(spark, sf), levels)


@query(
    "join_levels_anti",
    """SELECT DISTINCT 'region' AS feature, Region AS level FROM freq
       WHERE Region NOT IN (SELECT DISTINCT Region FROM freq WHERE BonusMalus = 50 AND VehAge = 0)
       UNION ALL SELECT DISTINCT 'veh_brand', VehBrand FROM freq
       WHERE VehBrand NOT IN (SELECT DISTINCT VehBrand FROM freq WHERE BonusMalus = 50 AND VehAge = 0)""",
)
def join_levels_anti(spark, sf):
    policies = layers.stored_policies(spark, sf)
    levels = profile.feature_levels(policies.where("BonusMalus = 50 AND VehAge = 0"), S)
    return quality.unknown_levels(cleaning.rename_snake_case(policies), levels)


def _leaky(spark, sf):
    """Gold rows plus a second label for some ids."""
    rows = layers.gold(spark, sf, "frequency").select("policy_id", "split")
    return rows.unionByName(rows.where("policy_id % 37 = 0").withColumn("split", F.lit("test")))


@query("assert_no_leakage", "SELECT policy_id FROM labels_ WHERE policy_id % 37 = 0 AND split <> 'test'")
def assert_no_leakage(spark, sf):
    split.assert_no_leakage(layers.gold(spark, sf, "frequency"))
    return split.leaked_ids(_leaky(spark, sf))


@query(
    "leak_sample",
    "SELECT policy_id FROM labels_ WHERE policy_id % 37 = 0 AND split <> 'test' ORDER BY policy_id LIMIT 20",
)
def leak_sample(spark, sf):
    return split.leak_sample(_leaky(spark, sf))


@query("assert_claims_only", "SELECT policy_id FROM silver WHERE claim_nb <= 0")
def assert_claims_only(spark, sf):
    quality.assert_claims_only(layers.gold(spark, sf, "severity"))
    return quality.without_claims(layers.silver_policies(spark, sf)).select("policy_id")


@query("claims_only_filter", "SELECT policy_id, claim_nb FROM silver WHERE claim_nb > 0")
def claims_only_filter(spark, sf):
    return quality.claims_only(layers.silver_policies(spark, sf)).select("policy_id", "claim_nb")


@query(
    "quarantine_missing_severity",
    """SELECT policy_id, 'kept' AS side, NULL AS _reason FROM silver
       UNION ALL SELECT policy_id, 'rejected', 'claim_nb positive but no severity record' FROM quarantine""",
)
def quarantine_missing_severity(spark, sf):
    kept, rejected = cleaning.split_quarantine(layers.all_policies(spark, sf))
    kept = kept.select("policy_id", F.lit("kept").alias("side"), F.lit(None).cast("string").alias("_reason"))
    return kept.unionByName(rejected.select("policy_id", F.lit("rejected").alias("side"), "_reason"))


@query("cap_exposure", "SELECT IDpol, round(Exposure, 6) AS Exposure FROM capped")
def cap_exposure(spark, sf):
    rows = cleaning.cap_exposure(layers.bronze_policies(spark, sf), S.cleaning.exposure_cap)
    return rounded(rows.select("IDpol", "Exposure"), 6, "Exposure")


@query("cap_claim_nb", "SELECT IDpol, ClaimNb FROM capped")
def cap_claim_nb(spark, sf):
    return cleaning.cap_claim_nb(layers.bronze_policies(spark, sf), S.cleaning.claim_cap).select("IDpol", "ClaimNb")


@query(
    "flag_duplicates",
    "SELECT IDpol, n_covariate_duplicates, n_covariate_duplicates > 1 AS is_duplicate_group FROM flagged",
)
def flag_duplicates(spark, sf):
    rows = cleaning.flag_duplicates(layers.stored_policies(spark, sf))
    return rows.select("IDpol", "n_covariate_duplicates", "is_duplicate_group")


@query(
    "join_group_size",
    "SELECT IDpol, count(*) OVER (PARTITION BY Region, VehBrand) AS n_covariate_duplicates FROM freq",
)
def join_group_size(spark, sf):
    rows = cleaning.flag_duplicates(layers.stored_policies(spark, sf), ["Region", "VehBrand"])
    return rows.select("IDpol", "n_covariate_duplicates")


@query(
    "aggregate_severity",
    """SELECT IDpol, round(total_claim_amount, 3) AS total_claim_amount, n_rows AS n_severity_rows,
              round(max_claim_amount, 3) AS max_claim_amount FROM sev_agg""",
)
def aggregate_severity(spark, sf):
    table = cleaning.aggregate_severity(layers.bronze_claims(spark, sf))
    return rounded(table, 3, "total_claim_amount", "max_claim_amount")


@query(
    "cap_large_losses",
    """SELECT IDpol, round(capped_claim_amount, 3) AS capped_claim_amount,
              round(excess_claim_amount, 3) AS excess_claim_amount FROM sev_agg""",
)
def cap_large_losses(spark, sf):
    table = cleaning.cap_large_losses(layers.bronze_claims(spark, sf), S.cleaning)
    return rounded(table, 3, "capped_claim_amount", "excess_claim_amount")


@query(
    "cap_large_losses_quantile",
    """WITH q AS (SELECT quantile_cont(ClaimAmount, 0.995) AS cap FROM sev)
       SELECT IDpol, round(sum(least(ClaimAmount, cap)), 3) AS capped_claim_amount,
              round(sum(ClaimAmount - least(ClaimAmount, cap)), 3) AS excess_claim_amount
       FROM sev, q GROUP BY IDpol""",
)
def cap_large_losses_quantile(spark, sf):
    table = cleaning.cap_large_losses(layers.stored_claims(spark, sf), Cleaning(large_loss_method="quantile"))
    return rounded(table, 3, "capped_claim_amount", "excess_claim_amount")


@query(
    "rename_snake_case",
    """SELECT IDpol AS policy_id, ClaimNb AS claim_nb, Exposure AS exposure, Area AS area, VehPower AS veh_power,
              VehAge AS veh_age, DrivAge AS driv_age, BonusMalus AS bonus_malus, VehBrand AS veh_brand,
              VehGas AS veh_gas, Density AS density, Region AS region FROM freq""",
)
def rename_snake_case(spark, sf):
    return cleaning.rename_snake_case(layers.bronze_policies(spark, sf).select(*POLICY_COLUMNS))


@query(
    "silver_ratios",
    """SELECT policy_id, round(claim_frequency, 6) AS claim_frequency, round(avg_claim_amount, 3) AS avg_claim_amount,
              round(pure_premium, 3) AS pure_premium FROM silver_all""",
)
def silver_ratios(spark, sf):
    rows = layers.all_policies(spark, sf).select("policy_id", "claim_frequency", "avg_claim_amount", "pure_premium")
    return rounded(rounded(rows, 6, "claim_frequency"), 3, "avg_claim_amount", "pure_premium")


@query(
    "large_loss_load",
    "SELECT round(sum(excess_claim_amount) / sum(exposure), 6) AS large_loss_load FROM silver_all",
)
def large_loss_load(spark, sf):
    return rounded(cleaning.large_loss_load(layers.all_policies(spark, sf)), 6, "large_loss_load")


@query(
    "clean_stats",
    """WITH p AS (SELECT count(*) AS n, count(*) FILTER (WHERE Exposure > 1) AS e,
                         count(*) FILTER (WHERE ClaimNb > 4) AS c FROM freq),
            j AS (SELECT count(*) FILTER (WHERE is_duplicate_group) AS d,
                         count(*) FILTER (WHERE ClaimNb > 0 AND NOT has_severity_record) AS m FROM joined),
            s AS (SELECT count(*) AS n, count(DISTINCT IDpol) AS ids, count(*) FILTER (WHERE ClaimAmount > 50000) AS l
                  FROM sev)
       SELECT 1 AS rank, 'cap_exposure' AS step, p.n AS rows_in, p.n AS rows_out, e AS rows_affected,
              'clipped Exposure to 1.0' AS note FROM p
       UNION ALL SELECT 2, 'cap_claim_nb', n, n, c, 'clipped ClaimNb to 4' FROM p
       UNION ALL SELECT 3, 'flag_duplicates', n, n, d, 'flagged rows sharing identical covariates' FROM p, j
       UNION ALL SELECT 4, 'aggregate_severity', n, ids, n, 'grouped severity rows by IDpol' FROM s
       UNION ALL SELECT 5, 'cap_large_losses', n, ids, l, 'capped ' || l || ' claims at 50000.00 (fixed)' FROM s
       UNION ALL SELECT 6, 'join_frequency_severity', n, n, m,
                        m || ' policies have claims but no severity record' FROM p, j
       UNION ALL SELECT 7, 'rename_snake_case', n, n, 0, 'renamed columns to snake_case' FROM p
       UNION ALL SELECT 8, 'assert_levels', n, n, 0, 'all categorical levels within config' FROM p""",
)
def clean_stats(spark, sf):
    return cleaning.clean_stats(layers.joined(spark, sf), layers.stored_claims(spark, sf), S.cleaning)


AMOUNT_ROUNDING = ", ".join(
    f"round({c}, 3) AS {c}"
    for c in ("total_claim_amount", "max_claim_amount", "capped_claim_amount", "excess_claim_amount")
)


@query(
    "join_frequency_severity",
    f"""SELECT IDpol, ClaimNb, {AMOUNT_ROUNDING}, n_severity_rows, has_severity_record, claim_count_mismatch
        FROM joined""",
)
def join_frequency_severity(spark, sf):
    rules = S.cleaning
    policies = cleaning.cap_claim_nb(layers.stored_policies(spark, sf), rules.claim_cap)
    severity = cleaning.severity_per_policy(layers.stored_claims(spark, sf), rules)
    rows = cleaning.join_frequency_severity(policies, severity).select(
        "IDpol", "ClaimNb", *cleaning.AMOUNTS, "n_severity_rows", "has_severity_record", "claim_count_mismatch"
    )
    return rounded(rows, 3, *cleaning.AMOUNTS)


@query(
    "silver_build",
    f"""SELECT policy_id, claim_nb, round(exposure, 6) AS exposure, area, veh_brand, region, n_covariate_duplicates,
               is_duplicate_group, {AMOUNT_ROUNDING}, n_severity_rows, has_severity_record, claim_count_mismatch,
               round(claim_frequency, 6) AS claim_frequency, round(avg_claim_amount, 3) AS avg_claim_amount,
               round(pure_premium, 3) AS pure_premium FROM silver""",
)
def silver_build(spark, sf):
    """The whole job over stored bronze tables, then its main output."""
    raw, out = _raw(spark, sf), fresh_path(spark, "layers")
    bronze.build_bronze(spark, raw, f"{out}/bronze", f"{out}/lineage", S)
    silver.build_silver(spark, f"{out}/bronze", f"{out}/silver", f"{out}/lineage", S)
    rows = readers.read_table(spark, f"{out}/silver/policies").select(
        "policy_id", "claim_nb", "exposure", "area", "veh_brand", "region", "n_covariate_duplicates",
        "is_duplicate_group", *cleaning.AMOUNTS, "n_severity_rows", "has_severity_record", "claim_count_mismatch",
        "claim_frequency", "avg_claim_amount", "pure_premium",
    )
    return rounded(
        rounded(rows, 6, "exposure", "claim_frequency"), 3, *cleaning.AMOUNTS, "avg_claim_amount", "pure_premium"
    )


@query(
    "pure_premium_by_area",
    """SELECT area, count(*) AS policies, sum(claim_nb)::BIGINT AS claims, round(sum(exposure), 4) AS exposure,
              round(sum(capped_claim_amount) / sum(exposure), 4) AS pure_premium FROM silver GROUP BY area""",
)
def pure_premium_by_area(spark, sf):
    """Raw tables to a segment table in one lazy plan."""
    kept, _ = silver.silver_tables(layers.bronze_policies(spark, sf), layers.bronze_claims(spark, sf), S)
    table = kept.groupBy("area").agg(
        F.count(F.lit(1)).alias("policies"),
        F.sum("claim_nb").alias("claims"),
        F.sum("exposure").alias("exposure"),
        (F.sum("capped_claim_amount") / F.sum("exposure")).alias("pure_premium"),
    )
    return rounded(table, 4, "exposure", "pure_premium")
