"""Hash keys that other SQL engines can reproduce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def salted_md5(key: Column, salt: int | str) -> Column:
    return F.md5(F.concat(F.lit(f"{salt}:"), key.cast("string")).cast("binary"))


def md5_number(text: Column) -> Column:
    """The first 32 bits of an md5 text as a non-negative bigint."""
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("bigint")


def fold_of(key: Column, folds: int, salt: int | str = "fold") -> Column:
    return F.pmod(md5_number(salted_md5(key, salt)), F.lit(folds)).cast("int")
