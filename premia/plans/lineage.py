"""Lineage of stored layers: one row per table and write, with a bundle hash per layer and its upstream bundle."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from premia.operators.digest import content_digest
from premia.sources import commits
from premia.sources.readers import read_commits

LINEAGE = (
    "layer string, table_name string, rows bigint, cols int, table_schema map<string,string>, content_digest string, "
    "bundle string, upstream string, extra string, created_at timestamp"
)


def schema_map(df: DataFrame) -> Column:
    pairs = [F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())]
    return F.create_map(*pairs)


def table_entry(name: str, df: DataFrame, digest: DataFrame | None = None) -> DataFrame:
    """One row (table_name, rows, cols, table_schema, content_digest)."""
    measured = digest if digest is not None else content_digest(df)
    return measured.select(
        F.lit(name).alias("table_name"), "rows", "cols", schema_map(df).alias("table_schema"), "content_digest"
    )


def with_bundle(entries: DataFrame) -> DataFrame:
    """Adds each layer's bundle: a hash over its sorted table digests (one short row per table)."""
    digests = F.array_sort(F.collect_list("content_digest").over(W.partitionBy("layer")))
    return entries.withColumn("bundle", F.sha2(F.concat_ws("", digests).cast("binary"), 256))


def manifest(layer: str, tables: dict[str, DataFrame]) -> DataFrame:
    entries = reduce(DataFrame.unionByName, [table_entry(name, df) for name, df in tables.items()])
    return with_bundle(entries.withColumn("layer", F.lit(layer)))


def record(
    spark: SparkSession,
    path: str,
    layer: str,
    tables: dict[str, DataFrame],
    upstream: str | None = None,
    extra: dict | None = None,
) -> None:
    rows = manifest(layer, tables).select(
        "layer",
        "table_name",
        F.col("rows").cast("bigint"),
        F.col("cols").cast("int"),
        "table_schema",
        "content_digest",
        "bundle",
        F.lit(upstream).cast("string").alias("upstream"),
        F.lit(json.dumps(extra) if extra else None).cast("string").alias("extra"),
        F.lit(datetime.now(timezone.utc).isoformat()).cast("timestamp").alias("created_at"),
    )
    append(spark, path, rows)


def append(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Commit lineage rows; there is one short row per table, and a layer's entries appear together."""
    lines = [r[0] for r in rows.select(F.to_json(F.struct("*"))).collect()]
    commits.commit(spark, path, lambda *_: "\n".join(lines))


def read_lineage(spark: SparkSession, path: str) -> DataFrame:
    return read_commits(spark, path, LINEAGE)


def bundles(lineage: DataFrame) -> DataFrame:
    """(layer, bundle, upstream, created_at): the last write of each layer."""
    last = F.max_by(F.struct("bundle", "upstream", "created_at"), "created_at").alias("s")
    return lineage.groupBy("layer").agg(last).select("layer", "s.*")


def latest_bundle(spark: SparkSession, path: str, layer: str, required: bool = False) -> str | None:
    row = bundles(read_lineage(spark, path).where(F.col("layer") == layer)).first()
    if row is None and required:
        raise FileNotFoundError(f"no lineage for layer {layer!r} at {path}")
    return row["bundle"] if row else None


def lineage_check(lineage: DataFrame) -> DataFrame:
    """(layer, upstream, linked): whether the upstream bundle of each layer's last write exists; only raw has none."""
    last = bundles(lineage)
    known = lineage.select(F.col("bundle").alias("upstream")).distinct().withColumn("linked", F.lit(True))
    checked = last.join(known, "upstream", "left")
    return checked.select(
        "layer", "upstream", ((F.col("layer") == "raw") | F.coalesce("linked", F.lit(False))).alias("linked")
    )
