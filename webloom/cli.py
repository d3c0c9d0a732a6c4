"""Command line: run the extraction of one crawl from its manifest to the deduplicated corpus."""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.operators import html, url
from webloom.operators.manifest import default_tasks, resume_row, with_row_index
from webloom.plans import pipeline, publish
from webloom.plans.profile import GREEK, Profile, load
from webloom.session import build
from webloom.sources.files import Store
from webloom.sources.records import backend, read_records


def extracted(rows: DataFrame, crawl: str, records: str, profile: Profile = GREEK, lists: dict[str, DataFrame] | None = None) -> DataFrame:
    """Stage one of numbered manifest rows: addresses are filtered first; each record left is fetched once and its main text
    taken in that pass, then judged and formatted in the next, without a shuffle."""
    allowed = url.banned(rows, lists, profile).where("ban is null").drop("ban")
    pages = read_records(allowed, crawl, backend(records), carry=("chunk",), extract=html.main_text)
    return publish.staged(pipeline.stage_one(pages, profile), "chunk")


def block_lists(spark: SparkSession, folder: str | None) -> dict[str, DataFrame]:
    """Block lists of a folder: domain.txt, host.txt and url.txt, one entry a line, as far as they are there."""
    store = Store(spark)
    return {k: spark.read.text(f"{folder}/{k}.txt") for k in url.KEYS if folder and store.exists(f"{folder}/{k}.txt")}


def run_chunks(spark: SparkSession, a: argparse.Namespace, rows: DataFrame, start: int, stage: str, publisher: publish.Publisher, profile: Profile) -> None:
    """Write the chunks that are not done yet, so many a job; a chunk is marked done, and published, when its job has ended."""
    store = Store(spark)
    chunks = [r[0] for r in rows.select("chunk").distinct().orderBy("chunk").collect()]  # one number a chunk
    done = {int(n[6:]) for n in store.names(stage) if n.startswith("_done_")}
    left = [c for c in chunks if c not in done]
    lists = block_lists(spark, a.block_lists)
    for k in range(0, len(left), a.chunks_per_job):
        some = left[k : k + a.chunks_per_job]
        part = rows.where(F.col("row_idx").between(some[0], some[-1] + a.chunk_size - 1) & F.col("chunk").isin(some)).repartition(max(a.tasks, spark.sparkContext.defaultParallelism))
        publish.write_chunks(extracted(part, a.crawl, a.records, profile, lists), stage)
        for c in some:
            folder = f"crawl={a.crawl}/chunk={c}"
            if publisher.target and store.exists(f"{stage}/{folder}"):
                publisher.publish(f"{stage}/{folder}", f"stage-1/{folder}")
            store.write(f"{stage}/_done_{c:012d}", "")
    for name in store.names(f"{stage}/crawl={a.crawl}"):  # left by a run in other chunks
        if name.startswith("chunk=") and int(name[6:]) >= start and int(name[6:]) not in chunks:
            store.delete(f"{stage}/crawl={a.crawl}/{name}")


def main(argv: list[str] | None = None) -> dict[str, int]:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("crawl")
    p.add_argument("--manifest", help="parquet manifest of the crawl; else that of the manifests folder, or the published one")
    p.add_argument("--manifests-dir", default="manifests")
    p.add_argument("--records", required=True, help="folder, http(s) address or s3 bucket of record files")
    p.add_argument("--out-dir", default="extractions")
    p.add_argument("--settings", help="filter settings as YAML or JSON")
    p.add_argument("--block-lists", help="folder with domain.txt, host.txt, url.txt of addresses that are not fetched")
    p.add_argument("--chunk-size", type=int, default=100_000)
    p.add_argument("--chunks-per-job", type=int, default=16)
    p.add_argument("--tasks", type=int, default=default_tasks(os.cpu_count() or 1))
    p.add_argument("--skip-published", action="store_true", help="fetch the chunks that are published and go on after them")
    p.add_argument("--publish-to")
    p.add_argument("--force", action="store_true", help="run again from the start even if there is output")
    a = p.parse_args(argv)
    spark = build("webloom-extract")
    store, publisher, profile = Store(spark), publish.Publisher(spark, a.publish_to), load(a.settings) if a.settings else GREEK
    root = f"{a.out_dir.rstrip('/')}/{a.crawl}"
    final, stage = f"{root}/final", f"{root}/stage-1"
    if store.exists(f"{final}/_SUCCESS") and not a.force:
        print(json.dumps({"skipped": final}))
        return {}
    path = a.manifest or f"{a.manifests_dir.rstrip('/')}/{a.crawl}.parquet"
    if not store.exists(path):
        publisher.fetch(f"manifests/{a.crawl}.parquet", path)
    start = 0
    if a.skip_published:
        have = publisher.chunks(f"stage-1/crawl={a.crawl}")
        start = resume_row(spark.createDataFrame([(c,) for c in have], "start_row bigint"))
    plan = json.dumps({"manifest": path, "chunk_size": a.chunk_size, "start": start})
    if a.force or store.read(f"{stage}/_plan") != plan:
        store.delete(root)
        store.write(f"{stage}/_plan", plan)
    if a.skip_published and start:
        for c in sorted(have):
            publisher.fetch(f"stage-1/crawl={a.crawl}/chunk={c}", f"{stage}/crawl={a.crawl}/chunk={c}")
    numbered = f"{root}/rows"
    if not store.exists(f"{numbered}/_SUCCESS"):  # once a run: jobs then read the row groups of their chunks
        with_row_index(spark.read.parquet(path)).repartitionByRange("row_idx").sortWithinPartitions("row_idx").write.mode("overwrite").parquet(numbered)
    rows = publish.with_chunk(spark.read.parquet(numbered), a.chunk_size, start)
    run_chunks(spark, a, rows, start, stage, publisher, profile)
    survivors = spark.read.schema(f"{publish.STAGE}, chunk bigint").parquet(stage).withColumn("doc_id", F.xxhash64("warc_filename", "warc_record_offset"))
    publish.write_final(publish.staged(pipeline.deduplicated(survivors), "cluster_id", "cluster_size"), final)
    publisher.publish(final, f"final/{a.crawl}")
    summary = publish.counts(survivors, spark.read.parquet(final))
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main()
