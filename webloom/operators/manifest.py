"""Building a crawl's manifest: selecting index records, keep-first dedup, slices and chunk arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom.plans.profile import GREEK, Profile

COLUMNS = ["url", "url_host_registered_domain", "content_digest", "content_languages", "warc_filename", "warc_record_offset", "warc_record_length"]
ORDER = ["warc_filename", "warc_record_offset"]
#: Bytes of a record file whose rows are numbered together.
BLOCK_BYTES = 1 << 28


def has_language(codes: Column, code: str) -> Column:
    """Exact member of a comma-separated list. The substring test before it can be pushed into the scan."""
    return codes.contains(code) & F.array_contains(F.split(codes, ","), code)


def wanted(index: DataFrame, profile: Profile = GREEK) -> DataFrame:
    """Records fetched well, in HTML, that list the language; null in any of the three drops the record."""
    return index.where((F.col("fetch_status") == 200) & F.col("content_mime_detected").isin(*profile.mimes) & has_language(F.col("content_languages"), profile.language))


def select_records(index: DataFrame, profile: Profile = GREEK) -> DataFrame:
    """The manifest's columns of the wanted records."""
    return wanted(index, profile).select(*COLUMNS)


def keep_first(manifest: DataFrame, key: str = "content_digest") -> DataFrame:
    """One row a digest: the first by file and offset (all columns break ties). Null digests are one group.

    A min over an ordering struct aggregates partially in each task, so a digest with a third of all rows costs one row
    a task, and dedup over slices and then over the slices' results comes by itself.
    """
    rest = [c for c in manifest.columns if c not in (*ORDER, key)]
    first = F.min(F.struct(*ORDER, *rest))
    return manifest.groupBy(key).agg(first.alias("first")).select(*[F.col(key) if c == key else F.col(f"first.{c}").alias(c) for c in manifest.columns])


def union(fragments: list[DataFrame], spark: SparkSession) -> DataFrame:
    """All fragments one under another; no fragment gives the empty manifest."""
    if not fragments:
        return spark.createDataFrame([], "url string, url_host_registered_domain string, content_digest string, content_languages string, warc_filename string, warc_record_offset bigint, warc_record_length bigint")
    return reduce(DataFrame.unionByName, fragments)


def with_row_index(manifest: DataFrame) -> DataFrame:
    """Rows numbered from 0 in manifest order, without sorting them in one task. Null files come first.

    Counts of each file and block of offsets are summed up (one small row a block), and rows are numbered within theirs, so
    that a file with a third of all rows is many tasks' work.
    """
    rest = [c for c in manifest.columns if c not in ORDER]
    own = manifest.withColumn("_block", F.floor(F.col("warc_record_offset") / BLOCK_BYTES))
    keys = ["warc_filename", "_block"]
    per_block = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    in_file = F.coalesce(F.sum("n").over(Window.partitionBy("warc_filename").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = per_block.groupBy("warc_filename").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("warc_filename").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = files.select(F.col("warc_filename").alias("_f"), before.alias("_start"))
    blocks = per_block.withColumn("_in_file", in_file).join(starts, F.col("warc_filename").eqNullSafe(F.col("_f"))).select(F.col("warc_filename").alias("_f"), F.col("_block").alias("_b"), (F.col("_start") + F.col("_in_file")).alias("_start"))
    k = F.row_number().over(Window.partitionBy(*keys).orderBy("warc_record_offset", *rest))
    met = own.withColumn("_own", k).join(blocks, F.col("warc_filename").eqNullSafe(F.col("_f")) & F.col("_block").eqNullSafe(F.col("_b")))
    return met.select((F.col("_start") + F.col("_own") - 1).cast("bigint").alias("row_idx"), *manifest.columns)


def slice_rows(indexed: DataFrame, offset: int = 0, limit: int = -1) -> DataFrame:
    """Rows offset..offset+limit-1 of a numbered manifest; a limit of -1 goes to the end."""
    part = indexed.where(F.col("row_idx") >= offset)
    return part if limit < 0 else part.where(F.col("row_idx") < offset + limit)


def rank_of(indexed: DataFrame, ranks: int, total: int) -> DataFrame:
    """Balanced contiguous ranks from 0: the first total % ranks get one row more. Arithmetic on row_idx, no window."""
    size, more = divmod(total, ranks)
    edge = more * (size + 1)
    i = F.col("row_idx")
    late = F.lit(more) + F.floor((i - edge) / F.lit(max(size, 1)))
    return indexed.withColumn("rank", F.when(i < edge, F.floor(i / F.lit(size + 1))).otherwise(late).cast("int"))


def chunk_bounds(total: DataFrame, size: int, start: int = 0) -> DataFrame:
    """(chunk, start_row, length, name) of chunks of `size` rows from `start`; `total` is a one-row frame with n_rows."""
    last = F.col("n_rows") - 1
    starts = F.when(last >= start, F.sequence(F.lit(start).cast("bigint"), last, F.lit(size).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    rows = total.select("n_rows", F.explode(starts).alias("start_row"))
    return rows.select("start_row", F.least(F.lit(size).cast("bigint"), F.col("n_rows") - F.col("start_row")).alias("length"), chunk_name(F.col("start_row")).alias("name"))


def chunk_name(offset: Column) -> Column:
    return F.concat(F.lit("chunk_"), F.lpad(offset.cast("string"), 12, "0"))


def resume_point(published: DataFrame) -> DataFrame:
    """(n_chunks, next_row, error) of published chunks (start_row, each once): where extraction goes on.

    Chunks must cover the rows from 0 without a gap at one distance; none at all is row 0, and of one alone the distance is
    unknown. Where that fails `error` says why and next_row is null.
    """
    step = F.col("start_row") - F.lag("start_row").over(Window.orderBy("start_row"))  # one row a chunk, no data rows
    facts = published.select("start_row", step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("start_row").alias("least"), F.max("start_row").alias("most"), F.min("step").alias("shortest"), F.max("step").alias("longest"))
    error = F.when(F.col("n") == 0, None).when(F.col("least") != 0, "the first chunk is missing").when(F.col("n") == 1, "one chunk alone does not tell the distance").when(F.col("shortest") != F.col("longest"), "a chunk is missing or of another size")
    return facts.select(F.col("n").cast("int").alias("n_chunks"), F.when(error.isNull(), F.coalesce(F.col("most") + F.col("longest"), F.lit(0))).cast("bigint").alias("next_row"), error.alias("error"))


def resume_row(published: DataFrame) -> int:
    """The row at which extraction goes on; an error if the published chunks do not tell it."""
    got = resume_point(published).first()
    if got["error"]:
        raise ValueError(got["error"])
    return int(got["next_row"])


def bucket_tasks(tasks: int, buckets: int = 14) -> int:
    return buckets * max(1, tasks // buckets)


def default_tasks(cpus: int) -> int:
    return max(1, cpus - 2)
