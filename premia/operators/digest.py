"""Content fingerprints that do not depend on row order or file layout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.functions.hashing import md5_number

#: A row's SHA-256 is added up in this many parts of 32 bits.
LIMBS = 8
#: The prime that sums are reduced by, so that a state has a fixed size.
PRIME = (1 << 61) - 1


def content_digest(df: DataFrame) -> DataFrame:
    """One row (rows, cols, content_digest): a hash over the number of rows and the sums of their SHA-256 limbs, one
    aggregate. Repeated rows count."""
    return finished(digest_state(df))


def digest_state(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row (rows, cols, limbs) that ``merged`` combines with the states of other tables with these columns.

    A row is hashed as JSON with its nulls, which has every column type and cannot confuse neighbouring columns. With
    ``columns`` (text and whole numbers) it is their text with ``|`` between and ``~`` for null, which other engines can
    repeat. A table without rows has sums of 0.
    """
    if columns is None:
        text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}) if df.columns else F.lit("{}")
    else:
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    hashed = df.select(F.sha2(text.cast("binary"), 256).alias("h"))
    limb = lambda i: F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("decimal(20,0)")
    sums = hashed.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(limb(i)).alias(f"s{i}") for i in range(LIMBS)])
    return sums.select("rows", F.lit(len(df.columns if columns is None else columns)).alias("cols"), _reduced([F.col(f"s{i}") for i in range(LIMBS)]))


def _reduced(sums: list[Column]) -> Column:
    prime = F.lit(PRIME).cast("decimal(20,0)")
    return F.array(*[F.pmod(F.coalesce(s, F.lit(0)), prime).cast("bigint") for s in sums]).alias("limbs")


def merged(*states: DataFrame) -> DataFrame:
    """The state of all rows of several tables from the tables' states, without reading the rows again: an appended part
    is digested alone. States of tables with other numbers of columns do not merge."""
    every = reduce(DataFrame.unionAll, states)
    sums = every.agg(
        F.sum("rows").alias("rows"),
        F.min("cols").alias("cols"),
        F.max("cols").alias("most"),
        *[F.sum(F.col("limbs")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(LIMBS)],
    )
    fault = F.raise_error(F.lit("digests of tables with different columns")).cast("int")
    return sums.select("rows", F.when(F.col("cols") == F.col("most"), F.col("cols")).otherwise(fault).alias("cols"), _reduced([F.col(f"s{i}") for i in range(LIMBS)]))


def finished(state: DataFrame) -> DataFrame:
    """(rows, cols, content_digest) of a state."""
    text = F.concat_ws(":", F.col("rows").cast("string"), *[F.col("limbs")[i].cast("string") for i in range(LIMBS)])
    return state.select("rows", "cols", F.sha2(text.cast("binary"), 256).alias("content_digest"))


def portable_digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """A hash over row count, sum and xor of short md5 numbers of text and whole-number columns."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    parts = df.select(md5_number(F.md5(text.cast("binary"))).alias("h")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.col("h").cast("decimal(20,0)")), F.lit(0)).alias("total"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("mixed"),
    )
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in ("rows", "total", "mixed")])
    return parts.select("rows", F.lit(len(columns)).alias("cols"), F.sha2(text.cast("binary"), 256).alias("content_digest"))
