"""Joins whose key may be held by a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted(many: DataFrame, few: DataFrame, keys: list[str], how: str, by: str, salts: int = SALTS) -> DataFrame:
    """`many` joined with `few` (one row a key), each key split over `salts` partitions by the column `by` of `many`.

    Whether or not the engine splits skewed partitions at run time, a key with a third of all rows is never one task's.
    """
    left = many.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    right = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
