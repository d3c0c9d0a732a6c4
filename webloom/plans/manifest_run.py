"""The index side of a crawl, step by step: seed, claim, fetch a part, record, merge at the gate, publish.

The status tables are kept as numbered snapshots below a folder: each step writes the whole new table beside the old one,
and a snapshot counts only when it is complete, so a run that is killed at any time goes on from the last step. One run
at a time writes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.operators import manifest, queue
from webloom.plans import publish
from webloom.plans.profile import GREEK, Profile
from webloom.sources import index
from webloom.sources.files import Store


class Tables:
    """Snapshots of crawls and parts below a folder; made without rows where there are none."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.store = spark, folder.rstrip("/"), Store(spark)
        self.schemas = {"crawls": queue.CRAWLS, "parts": queue.PARTS}
        for name, empty in zip(self.schemas, queue.empty_tables(spark), strict=True):
            if self._last(name) is None:
                self.put(name, empty)

    def _versions(self, name: str) -> list[int]:
        return sorted(int(n[1:]) for n in self.store.names(f"{self.folder}/{name}") if n[:1] == "v" and self.store.exists(f"{self.folder}/{name}/{n}/_SUCCESS"))

    def _last(self, name: str) -> int | None:
        return max(self._versions(name), default=None)

    def get(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.folder}/{name}/v{self._last(name):08d}")

    def put(self, name: str, table: DataFrame) -> None:
        """The new snapshot; of the older ones the last is kept."""
        had = self._versions(name)
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{name}/v{(had[-1] if had else 0) + 1:08d}")
        for v in had[:-1]:
            self.store.delete(f"{self.folder}/{name}/v{v:08d}")


def seed(tables: Tables, wanted: list[str], paths: Callable[[str], DataFrame], now: F.Column) -> str | None:
    """Register the parts of the first crawl of a list that is not seeded yet; its id, None if all are.

    `paths(crawl)` gives (part_index, part_url), as sources.index.part_paths does.
    """
    listed = tables.spark.createDataFrame([(c,) for c in wanted], "crawl_id string")
    first = queue.remaining(listed, tables.get("crawls")).limit(1).collect()
    if not first:
        return None
    crawl = first[0][0]
    parts = paths(crawl).select(F.lit(crawl).alias("crawl_id"), "part_url", "part_index")
    total = parts.groupBy("crawl_id").agg(F.count(F.lit(1)).cast("int").alias("total_parts"))
    # Parts first: a run killed in between finds the crawl unseeded and registers it again, which changes nothing.
    tables.put("parts", queue.register(tables.get("parts"), parts, now))
    tables.put("crawls", queue.upsert_crawl(tables.get("crawls"), total, now))
    return crawl


def fetch(spark: SparkSession, out: str, crawl: str, url: str, part: int, profile: Profile = GREEK) -> tuple[str, int]:
    """Select one index part into its fragment: (path, rows)."""
    rows = manifest.select_records(index.scan(spark, url, schema=index.INDEX), profile)
    path = publish.write_fragment(rows, f"{out.rstrip('/')}/{crawl}/fragments", part)
    return path, spark.read.parquet(path).count()


def merge(spark: SparkSession, paths: list[str], out: str) -> int:
    """All fragments as one sorted manifest without repeated digests; its rows."""
    publish.write_manifest(manifest.keep_first(index.scan(spark, *paths)), out)
    return spark.read.parquet(out).count()


def run_once(spark: SparkSession, state: str, out: str, wanted: list[str], paths: Callable[[str], DataFrame], limit: int = 1, min_ratio: float = 1.0, publisher: publish.Publisher | None = None, clean: bool = False, profile: Profile = GREEK, now: F.Column | None = None) -> dict[str, object]:
    """One scheduled run: claim up to `limit` parts (seeding the next crawl if none is pending), fetch each, then merge the
    crawl that is ready, if its share of successful parts reaches `min_ratio`, and publish it.

    A part that fails goes back to the queue, at last as failed; a crawl below the ratio has its failed parts queued again.
    Parts of a crawl are few and each is a distributed job, so the loop over them is on the driver.
    """
    now = F.current_timestamp() if now is None else now
    tables = Tables(spark, state)
    done: dict[str, object] = {"fetched": 0, "failed": 0, "seeded": None, "merged": None, "requeued": None}
    if not queue.next_parts(tables.get("parts"), 1).count():
        done["seeded"] = seed(tables, wanted, paths, now)
    mine = [r.asDict() for r in queue.next_parts(tables.get("parts"), limit).collect()]
    if mine:
        tables.put("parts", queue.claim(tables.get("parts"), limit, now))
    for p in mine:
        this = F.col("id") == p["id"]
        try:
            path, rows = fetch(spark, out, p["crawl_id"], p["part_url"], p["part_index"], profile)
        except Exception as e:
            tables.put("parts", queue.mark_error(tables.get("parts"), this, F.lit(str(e)), now=now))
            done["failed"] = int(done["failed"]) + 1
            continue
        tables.put("parts", queue.mark_success(tables.get("parts"), this, F.lit(path), F.lit(rows), now))
        done["fetched"] = int(done["fetched"]) + 1
    gate = queue.merge_gate(tables.get("crawls"), tables.get("parts"), min_ratio).orderBy("crawl_id").limit(1).collect()
    if not gate:
        return done
    crawl, this = gate[0]["crawl_id"], F.col("crawl_id") == gate[0]["crawl_id"]
    if gate[0]["action"] == "requeue":
        tables.put("parts", queue.requeue_failed(tables.get("parts"), this, now))
        return {**done, "requeued": crawl}
    tables.put("crawls", queue.mark_merging(tables.get("crawls"), this, now))
    found = [r["fragment_path"] for r in queue.fragments(tables.get("parts")).where(this).orderBy("part_index").collect()]
    target = f"{out.rstrip('/')}/{crawl}.parquet"
    rows = merge(spark, found, target)
    tables.put("crawls", queue.mark_done(tables.get("crawls"), this, tables.get("parts"), F.lit(target), F.lit(rows), min_ratio, now))
    if publisher:
        publisher.publish(target, f"manifests/{crawl}.parquet", clean)
        if clean and publisher.target:
            tables.store.delete(f"{out.rstrip('/')}/{crawl}")
    return {**done, "merged": crawl, "rows": rows}
