"""Named parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webloom.sources.files import Store

#: Bytes a core up to which rows of few files are dealt out; larger ones hold row groups enough for every core.
SPREAD_BYTES = 32 << 20


def table(spark: SparkSession, directory: str, name: str, spread: bool = False) -> DataFrame:
    """The table `name` of a directory that holds one parquet file or folder per table.

    Few small files have few row groups and so few tasks. With `spread`, for work that costs far more than moving the
    rows, the rows of fewer files than cores are dealt out, if they are small; all else is left as it is.
    """
    path = f"{directory.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    if not spread:
        return df
    cores = spark.sparkContext.defaultParallelism
    files, size = Store(spark).size(path)
    return df.repartition(cores) if files < cores and size <= cores * SPREAD_BYTES else df
