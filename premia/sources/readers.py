"""Readers for stored tables. Schemas are given, never inferred from data, wherever the layer fixes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.sources import commits


#: Where a published table keeps its pointers; Spark does not read folders of such names.
POINTERS = "_versions"


def current_path(spark: SparkSession, path: str) -> str:
    """The folder of the last published version, or ``path`` itself for a table written without versions."""
    pointer = commits.latest(spark, f"{path}/{POINTERS}")
    return f"{path}/{pointer['folder']}" if pointer else path


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(current_path(spark, path))


def read_commits(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all commit files below ``path``; none where nothing is stored; every other fault is raised."""
    if not commits.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(path)


def read_split(spark: SparkSession, gold_path: str, split: str) -> DataFrame:
    """One split of a gold table; the filter on the partition column prunes the other folders."""
    return read_table(spark, gold_path).where(F.col("split") == split).drop("split")


def row_count(df: DataFrame) -> int:
    """Reads no column, so Parquet answers from its footers."""
    return df.count()
