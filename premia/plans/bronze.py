"""Bronze layer: casts, audit columns, profiles, level lists."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.operators.digest import content_digest
from premia.operators.profile import feature_levels, profile_columns
from premia.operators.quality import bronze_claim_rules, bronze_policy_rules, validate_strict
from premia.plans import lineage
from premia.settings import Settings
from premia.sources.readers import read_table
from premia.sources.schemas import RAW_CLAIM_FIELDS, RAW_POLICY_FIELDS
from premia.sources.sinks import write_table


def _cast(raw: DataFrame, fields, ingested_at: datetime, source_hash: str) -> DataFrame:
    columns = [F.col(name).cast(kind).alias(name) for name, kind in fields]
    stamp = F.lit(ingested_at.astimezone(timezone.utc).isoformat()).cast("timestamp").alias("_ingested_at")
    return raw.select(*columns, stamp, F.lit(source_hash).alias("_source_hash"))


def bronze_policies(raw: DataFrame, ingested_at: datetime, source_hash: str) -> DataFrame:
    return _cast(raw, RAW_POLICY_FIELDS, ingested_at, source_hash)


def bronze_claims(raw: DataFrame, ingested_at: datetime, source_hash: str) -> DataFrame:
    return _cast(raw, RAW_CLAIM_FIELDS, ingested_at, source_hash)


def validate_bronze(spark: SparkSession, bronze_path: str, settings: Settings) -> DataFrame:
    """(table_name, rows) of both bronze tables, once each has passed all of its rules; else the rules' error."""
    rules = {"policies": bronze_policy_rules(settings), "claims": bronze_claim_rules(settings)}
    checked = [validate_strict(read_table(spark, f"{bronze_path}/{n}"), r).select(F.lit(n).alias("table_name")) for n, r in rules.items()]
    counts = reduce(DataFrame.unionByName, checked).groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))
    names = spark.createDataFrame([(n,) for n in rules], "table_name string")
    return names.join(counts, "table_name", "left").na.fill(0, ["rows"])


def build_bronze(spark: SparkSession, raw_path: str, out_path: str, lineage_path: str, settings: Settings) -> None:
    """Raw tables ``policies`` and ``claims`` below ``raw_path`` to bronze tables, profiles, levels and lineage."""
    now = datetime.now(timezone.utc)
    casts = {"policies": bronze_policies, "claims": bronze_claims}
    tables = {}
    raws = {name: read_table(spark, f"{raw_path}/{name}") for name in casts}
    lineage.record(spark, lineage_path, "raw", raws)
    for name, cast in casts.items():
        source_hash = content_digest(raws[name]).first()["content_digest"]
        write_table(cast(raws[name], now, source_hash), f"{out_path}/{name}")
        tables[name] = read_table(spark, f"{out_path}/{name}")
        write_table(profile_columns(tables[name]), f"{out_path}/profile_{name}")
    write_table(feature_levels(tables["policies"], settings), f"{out_path}/levels")
    lineage.record(spark, lineage_path, "bronze", tables, upstream=lineage.latest_bundle(spark, lineage_path, "raw", required=True))
