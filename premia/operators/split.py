"""Train / validation / test labels by id group inside strata, with exact quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from premia.functions.hashing import salted_md5
from premia.settings import Splitting
from premia.workspace import stored

PREFIX_DIGITS = 4


def _cutoffs(ids: DataFrame, settings: Splitting) -> DataFrame:
    """Per stratum the hash of the last test id and of the last validation id.

    The ranks wanted are found through counts per hash prefix (at most 16**4 per stratum); only the few prefixes that
    hold a wanted rank are ranked row by row.
    """
    prefix = F.substring("_hash", 1, PREFIX_DIGITS)
    counts = ids.groupBy("_stratum", prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_size"))
    running = W.partitionBy("_stratum").orderBy("_prefix").rowsBetween(W.unboundedPreceding, W.currentRow)
    all_rows = W.partitionBy("_stratum")
    n = F.col("_n").cast("double")
    test = F.ceil(n * F.lit(settings.test_share))
    val = F.ceil((F.col("_n") - F.col("_test")) * F.lit(settings.val_share / (1 - settings.test_share)))
    quotas = (
        counts.withColumn("_n", F.sum("_size").over(all_rows))
        .withColumn("_upto", F.sum("_size").over(running))
        .withColumn("_test", test)
        .withColumn("_val", val + F.col("_test"))
    )
    before = F.col("_upto") - F.col("_size")
    needed = quotas.select(
        "_stratum",
        "_prefix",
        before.alias("_before"),
        F.filter(F.array("_test", "_val"), lambda r: (r > before) & (r <= F.col("_upto"))).alias("_ranks"),
        "_test",
        "_val",
    ).where(F.size("_ranks") > 0)
    inside = W.partitionBy("_stratum", "_prefix").orderBy("_hash", "_id")
    ranked = (
        ids.withColumn("_prefix", prefix)
        .join(F.broadcast(needed), ["_stratum", "_prefix"])
        .withColumn("_rank", F.row_number().over(inside) + F.col("_before"))
        .where(F.array_contains("_ranks", F.col("_rank")))
    )
    return ranked.groupBy("_stratum").agg(
        F.max(F.when(F.col("_rank") == F.col("_test"), F.col("_hash"))).alias("_last_test"),
        F.max(F.when(F.col("_rank") == F.col("_val"), F.col("_hash"))).alias("_last_val"),
    )


def grouped_split(df: DataFrame, settings: Splitting, id_column: str = "policy_id") -> DataFrame:
    """Adds ``split``. Inside each stratum (with and without claims) ids are ordered by a salted hash: the first
    ceil(test share) are test, the next ceil(validation share of the rest) validation, the others train.

    The cutoffs are two hashes per stratum. Labelling compares each row's hash with them, so the rows themselves are
    never shuffled.
    """
    stratum = F.col("claim_nb") > 0
    # Ids alone are exchanged and stored; their hashes, several times as long, are made on reading.
    ids = stored(df.select(stratum.alias("_stratum"), F.col(id_column).alias("_id")).distinct(), "split-ids")
    ids = ids.withColumn("_hash", salted_md5(F.col("_id"), settings.seed))
    hash_value = F.col("_hash")
    label = F.lit("train")
    for row in _cutoffs(ids, settings).collect():
        own = F.when(hash_value <= F.lit(row["_last_test"]), "test").when(
            hash_value <= F.lit(row["_last_val"]), "val"
        )
        label = F.when(stratum == F.lit(row["_stratum"]), own.otherwise("train")).otherwise(label)
    return df.withColumn("_hash", salted_md5(F.col(id_column), settings.seed)).withColumn("split", label).drop("_hash")


def leaked_ids(df: DataFrame, label_column: str = "split", id_column: str = "policy_id") -> DataFrame:
    """Ids that carry more than one label."""
    per_id = df.groupBy(id_column).agg(F.min(label_column).alias("_low"), F.max(label_column).alias("_high"))
    return per_id.where(F.col("_low") != F.col("_high")).select(id_column)


def leak_sample(df: DataFrame, label_column: str = "split", size: int = 20) -> DataFrame:
    return leaked_ids(df, label_column).orderBy("policy_id").limit(size)


def assert_no_leakage(df: DataFrame, label_column: str = "split") -> None:
    sample = [row[0] for row in leak_sample(df, label_column).collect()]
    if sample:
        raise ValueError(f"the splits share policies, for example {sample}")
