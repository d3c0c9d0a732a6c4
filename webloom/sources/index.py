"""Listing and scanning index parts and fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom.operators.manifest import union

#: The columns of the crawl index that are read; parts written at other times may hold more or order them otherwise.
INDEX = "url string, url_host_registered_domain string, content_digest string, content_languages string, content_mime_detected string, fetch_status int, warc_filename string, warc_record_offset bigint, warc_record_length bigint"


def part_paths(paths: DataFrame, crawl: str, root: str) -> DataFrame:
    """(part_index, part_url) of the lines of a path list (column value) that belong to a crawl's record subset, in order of path."""
    own = paths.where(F.col("value").contains(f"crawl={crawl}/subset=warc/"))
    return own.select((F.row_number().over(Window.orderBy("value")) - 1).alias("part_index"), F.concat(F.lit(root.rstrip("/") + "/"), "value").alias("part_url"))


def path_list(spark: SparkSession, file: str) -> DataFrame:
    """Lines of a path list; gzip is read as such."""
    return spark.read.text(file)


def scan(spark: SparkSession, *paths: str, schema: str | None = None) -> DataFrame:
    """Fragments at paths or globs as one frame; key=value folders are not read as columns. A given schema is not inferred."""
    if not paths:
        return union([], spark)
    reader = spark.read.option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema else reader).parquet(*paths)


def published_chunks(names: DataFrame, column: str = "name") -> DataFrame:
    """Distinct offsets of published chunk files by name."""
    return names.select(chunk_offset(F.col(column)).alias("start_row")).where("start_row is not null").distinct()


def chunk_offset(name: Column) -> Column:
    """The offset in a chunk's file name, null for other names."""
    return F.try_to_number(F.nullif(F.regexp_extract(name, "(?:^|/)chunk_(\\d{12})(?:\\.parquet)?$", 1), F.lit("")), F.lit("999999999999")).cast("bigint")


def file_kind(name: Column, size: Column, tasks: int) -> Column:
    """What a cleaner does with an output file: empty, stale (rank beyond the tasks) or keep."""
    rank = F.nullif(F.regexp_extract(name, "(?:^|/)\\d+_(\\d+)\\.parquet$", 1), F.lit("")).cast("int")
    return F.when(size == 0, "empty").when(rank >= tasks, "stale").otherwise("keep")
