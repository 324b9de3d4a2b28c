"""Policies, claims, quotes and a request log derived from the supplied order tables.

The expressions use only arithmetic that gives the same bits in every SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.operators.skew import salted_lookup
from premia.sources.schemas import QUOTE_FIELDS, SNAKE_NAMES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per claim: IDpol, ClaimAmount."""
    lines = _table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' AND l_quantity >= 40")
    return lines.selectExpr(
        "cast(l_orderkey AS double) AS IDpol",
        "l_extendedprice * l_extendedprice / cast(200000 AS double) AS ClaimAmount",
    )


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per policy, in the raw column layout."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    customers = _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS o_custkey", "c_nationkey", "c_acctbal"
    )
    per_order = (
        _table(spark, sf_dir, "lineitem")
        .where("l_returnflag = 'R' AND l_quantity >= 40")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    joined = salted_lookup(orders, customers, ["o_custkey"], ["o_orderkey"], how="inner")
    joined = joined.join(per_order, "o_orderkey", "left")
    return joined.selectExpr(
        "cast(o_orderkey AS double) AS IDpol",
        """cast(CASE WHEN o_orderkey % 101 = 0 THEN 0
                     WHEN o_orderkey % 1013 = 5 THEN 6
                     ELSE coalesce(n, 0) + CASE WHEN o_orderkey % 97 = 3 THEN 1 ELSE 0 END END AS bigint) AS ClaimNb""",
        "(1 + o_custkey % 26) * cast(0.05 AS double) AS Exposure",
        "substr('ABCDEF', cast(1 + o_custkey % 6 AS int), 1) AS Area",
        "4 + o_custkey % 12 AS VehPower",
        "CASE WHEN o_custkey % 50 = 0 THEN 100 ELSE (o_custkey * 7) % 25 END AS VehAge",
        "18 + o_custkey % 83 AS DrivAge",
        "50 + 10 * (o_orderkey % 4) AS BonusMalus",
        "concat('B', cast(1 + o_custkey % 7 AS string)) AS VehBrand",
        "CASE WHEN o_orderstatus = 'F' THEN 'Diesel' ELSE 'Regular' END AS VehGas",
        "1 + abs(c_acctbal) AS Density",
        "concat('R', cast(c_nationkey AS string)) AS Region",
    )


def faulty_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw policies with planted faults: bad ages, areas, exposures, counts, missing regions, repeated ids."""
    spoiled = policies(spark, sf_dir).selectExpr(
        "IDpol",
        "CASE WHEN cast(IDpol AS bigint) % 61 = 7 THEN -1 ELSE ClaimNb END AS ClaimNb",
        "CASE WHEN cast(IDpol AS bigint) % 53 = 1 THEN cast(0 AS double) ELSE Exposure END AS Exposure",
        "CASE WHEN cast(IDpol AS bigint) % 47 = 2 THEN 'Z' ELSE Area END AS Area",
        "VehPower",
        "VehAge",
        "CASE WHEN cast(IDpol AS bigint) % 50 = 0 THEN 200 ELSE DrivAge END AS DrivAge",
        "CASE WHEN cast(IDpol AS bigint) % 59 = 4 THEN 351 ELSE BonusMalus END AS BonusMalus",
        "VehBrand",
        "VehGas",
        "Density",
        "CASE WHEN cast(IDpol AS bigint) % 43 = 3 THEN NULL ELSE Region END AS Region",
    )
    repeated = spoiled.where("cast(IDpol AS bigint) % 89 = 6")
    return spoiled.unionByName(repeated)


def quotes(policies: DataFrame) -> DataFrame:
    """Quote requests: policy columns in snake case, with an impossible driver age on every fiftieth row."""
    base = policies.withColumnsRenamed(SNAKE_NAMES).select(*QUOTE_FIELDS)
    return base.withColumn("policy_id", F.col("policy_id").cast("bigint")).withColumn(
        "driv_age", F.when(F.col("policy_id") % 50 == 0, F.lit(200)).otherwise(F.col("driv_age")).cast("bigint")
    )


def request_log(events: DataFrame) -> DataFrame:
    """Request log rows from event rows; works on batch and streaming input alike."""
    return events.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("latency_ms"),
        F.when(F.col("event_type") == "purchase", F.col("value") * 10).alias("prediction"),
    )
