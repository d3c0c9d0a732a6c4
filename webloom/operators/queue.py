"""Status tables of parts and crawls as queries and as transitions that give the new table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAX_ATTEMPTS = 5
CRAWLS = "crawl_id string, status string, total_parts int, success_parts int, failed_parts int, min_success_ratio_used double, output_path string, row_count bigint, last_error string, started_at timestamp, finished_at timestamp, created_at timestamp, updated_at timestamp"
PARTS = "id bigint, crawl_id string, part_url string, part_index int, status string, fragment_path string, row_count bigint, attempt_count int, last_error string, started_at timestamp, finished_at timestamp, created_at timestamp, updated_at timestamp"


def empty_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The two tables (crawls, parts) without rows."""
    return spark.createDataFrame([], CRAWLS), spark.createDataFrame([], PARTS)


def _changed(table: DataFrame, hit: Column, values: dict[str, Column]) -> DataFrame:
    """The table with the given values where `hit`; all other rows and columns as they are. A null test is no hit."""
    hit = F.coalesce(hit, F.lit(False))
    types = {f.name: f.dataType for f in table.schema.fields}
    return table.select(*[F.when(hit, values[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in table.columns])


def status_counts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("crawl_id", "status").agg(F.count(F.lit(1)).alias("n_parts"))


def success_ratio(parts: DataFrame) -> DataFrame:
    """Total, successful parts and their exact share by crawl; 0.0 of none."""
    ok = F.count(F.when(F.col("status") == "success", 1))
    return parts.groupBy("crawl_id").agg(F.count(F.lit(1)).alias("total"), ok.alias("success")).withColumn("ratio", F.when(F.col("total") > 0, F.col("success") / F.col("total")).otherwise(0.0))


def open_parts(parts: DataFrame) -> DataFrame:
    return parts.where(F.col("status").isin("pending", "running"))


def ready_crawls(crawls: DataFrame, parts: DataFrame) -> DataFrame:
    """Crawls under way without a pending or running part."""
    return crawls.where(F.col("status").isin("fetching", "merging")).join(open_parts(parts), "crawl_id", "left_anti")


def merge_gate(crawls: DataFrame, parts: DataFrame, min_ratio: float = 1.0) -> DataFrame:
    """(crawl_id, total, success, ratio, action) of each ready crawl: merge, or requeue if too few parts succeeded.

    A crawl without parts has ratio 0.
    """
    own = ready_crawls(crawls, parts).select("crawl_id").join(success_ratio(parts), "crawl_id", "left").fillna(0, ["total", "success"]).fillna(0.0, ["ratio"])
    return own.withColumn("action", F.when(F.col("ratio") < min_ratio, "requeue").otherwise("merge"))


def next_parts(parts: DataFrame, limit: int) -> DataFrame:
    """The oldest pending parts: by crawl, then index, then id."""
    return parts.where("status = 'pending'").orderBy("crawl_id", "part_index", "id").limit(limit)


def claim(parts: DataFrame, limit: int, now: Column) -> DataFrame:
    """The table with the next parts running and one attempt more."""
    mine = next_parts(parts, limit).select("id", F.lit(True).alias("mine"))
    joined = parts.join(mine, "id", "left")
    return _changed(joined, F.col("mine"), {"status": F.lit("running"), "attempt_count": F.col("attempt_count") + 1, "started_at": now, "updated_at": now}).select(*parts.columns)


def mark_success(parts: DataFrame, which: Column, fragment: Column, rows: Column, now: Column) -> DataFrame:
    return _changed(parts, which, {"status": F.lit("success"), "fragment_path": fragment, "row_count": rows, "last_error": F.lit(None), "finished_at": now, "updated_at": now})


def mark_error(parts: DataFrame, which: Column, error: Column, max_attempts: int = MAX_ATTEMPTS, now: Column | None = None) -> DataFrame:
    """Failed after the last attempt, else pending again; the message is cut to 2000 characters."""
    again = F.when(F.col("attempt_count") >= max_attempts, "failed").otherwise("pending")
    return _changed(parts, which, {"last_error": F.substring(error, 1, 2000), "status": again, **({"updated_at": now} if now is not None else {})})


def requeue_failed(parts: DataFrame, crawl: Column, now: Column | None = None) -> DataFrame:
    return _changed(parts, (F.col("status") == "failed") & crawl, {"attempt_count": F.lit(0), "status": F.lit("pending"), **({"updated_at": now} if now is not None else {})})


def release_stale(parts: DataFrame, before: Column) -> DataFrame:
    """Parts left running since before a time are pending again (a lease; nothing else frees them after a hard kill)."""
    return _changed(parts, (F.col("status") == "running") & (F.col("started_at") < before), {"status": F.lit("pending")})


def fragments(parts: DataFrame) -> DataFrame:
    return parts.where("status = 'success' and fragment_path is not null").select("crawl_id", "part_index", "fragment_path", "row_count")


def register(parts: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """The table with the parts of `new` (crawl_id, part_url, part_index) that were not in it, as pending.

    Existing parts are never reset. New ids go on from the largest; a part that stands in `new` more than once is taken once,
    with its least index.
    """
    once = new.groupBy("crawl_id", "part_url").agg(F.min("part_index").alias("part_index"))
    fresh = once.join(parts.select("crawl_id", "part_url"), ["crawl_id", "part_url"], "left_anti")
    last = parts.agg(F.max("id")).first()[0] or 0
    # One row a part of the index: some hundred a crawl.
    numbered = fresh.withColumn("k", F.row_number().over(Window.orderBy("crawl_id", "part_index", "part_url")))
    values = {"id": F.lit(last) + F.col("k"), "status": F.lit("pending"), "attempt_count": F.lit(0), "created_at": now, "updated_at": now, **{c: F.col(c) for c in ("crawl_id", "part_url", "part_index")}}
    return parts.unionByName(numbered.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in parts.schema.fields]))


def upsert_crawl(crawls: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """The table with the crawls of `new` (crawl_id, total_parts) inserted or set to fetching.

    A start time is kept, as are all other columns of a crawl that was there.
    """
    n = new.groupBy("crawl_id").agg(F.max("total_parts").alias("new_parts"))
    met = crawls.withColumn("_was", F.lit(True)).join(n, "crawl_id", "full")
    hit, fresh = F.col("new_parts").isNotNull(), F.col("_was").isNull()
    out = _changed(met, hit, {"status": F.lit("fetching"), "total_parts": F.col("new_parts"), "started_at": F.coalesce("started_at", now), "updated_at": now})
    return _changed(out, fresh, {"created_at": now}).select(*crawls.columns)


def remaining(wanted: DataFrame, seeded: DataFrame) -> DataFrame:
    """Crawls of a list that are not seeded, in order."""
    return wanted.join(seeded.select("crawl_id").distinct(), "crawl_id", "left_anti").orderBy("crawl_id")


def orphans(parts: DataFrame, crawls: DataFrame) -> DataFrame:
    """Parts of no crawl."""
    return parts.join(crawls, "crawl_id", "left_anti")


def mark_merging(crawls: DataFrame, which: Column, now: Column) -> DataFrame:
    return _changed(crawls, which, {"status": F.lit("merging"), "updated_at": now})


def mark_done(crawls: DataFrame, which: Column, parts: DataFrame, output: Column, rows: Column, min_ratio: float, now: Column) -> DataFrame:
    """The crawls `which` done, with the counts of their parts, the output's path and rows, and no error."""
    counts = success_ratio(parts).select("crawl_id", "total", "success")
    met = crawls.join(counts, "crawl_id", "left")
    success = F.coalesce("success", F.lit(0))
    values = {"status": F.lit("done"), "output_path": output, "row_count": rows, "success_parts": success, "failed_parts": F.coalesce("total", F.lit(0)) - success, "min_success_ratio_used": F.lit(min_ratio), "last_error": F.lit(None), "finished_at": now, "updated_at": now}
    return _changed(met, which, values).select(*crawls.columns)
