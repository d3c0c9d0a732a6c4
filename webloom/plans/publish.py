"""Writing and publishing: fragments, manifests, chunks and final corpora."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.operators.manifest import ORDER
from webloom.sources.files import Store

#: Columns of the first stage's output; other columns are not written.
STAGE = "id string, text string, crawl string, content_digest string, url string, url_host_registered_domain string, warc_filename string, warc_record_offset bigint, language string, language_score double, language_script string"


def write_fragment(df: DataFrame, root: str, index: int) -> str:
    """One part of the index as a folder of its own, replaced as a whole; as many files as the scan has tasks with rows."""
    out = f"{root.rstrip('/')}/part-{index:05d}.parquet"
    df.write.option("compression", "zstd").mode("overwrite").parquet(out)
    return out


def write_manifest(df: DataFrame, out: str, partitions: int | None = None) -> None:
    """The merged manifest, globally sorted by file and offset through ranges, never in one task."""
    ranged = df.repartitionByRange(partitions, *ORDER) if partitions else df.repartitionByRange(*ORDER)
    ranged.sortWithinPartitions(*ORDER).write.option("compression", "zstd").mode("overwrite").parquet(out)


def staged(df: DataFrame, *more: str) -> DataFrame:
    """The first stage's columns with their types, and the columns `more`."""
    names = [x.split()[0] for x in STAGE.split(", ")]
    return df.select(*[F.col(n).cast(x.split()[1]).alias(n) for n, x in zip(names, STAGE.split(", "), strict=True)], *more)


def write_chunks(df: DataFrame, out: str) -> None:
    """Survivors by crawl and chunk; only the chunks present are replaced, each in one file."""
    df.repartition("crawl", "chunk").write.option("compression", "zstd").option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("crawl", "chunk").parquet(out)


def write_final(df: DataFrame, out: str) -> None:
    df.write.option("compression", "zstd").mode("overwrite").parquet(out)


class Publisher:
    """Copies results to a target folder of any store; without a target it warns and does nothing."""

    def __init__(self, spark: SparkSession, target: str | None) -> None:
        self.store, self.target = Store(spark), target.rstrip("/") if target else None

    def publish(self, local: str, prefix: str, clean: bool = False) -> list[str]:
        """The data files of a folder under a prefix of the target, in place of what lay there; `clean` then deletes the folder."""
        if not self.target:
            warnings.warn(f"no publishing target; {local} stays where it is", stacklevel=2)
            return []
        to = f"{self.target}/{prefix}"
        names = self.store.files(local)
        for old in set(self.store.files(to)) - set(names):
            self.store.delete(f"{to}/{old}")
        for name in names:
            self.store.copy(f"{local.rstrip('/')}/{name}", f"{to}/{name}")
        if clean:
            self.store.delete(local)
        return [f"{to}/{name}" for name in names]

    def fetch(self, prefix: str, into: str) -> list[str]:
        """The published files under a prefix, copied into a folder unless a copy with content is there; an error if there are none."""
        if not self.target:
            raise FileNotFoundError(f"no publishing target to fetch {prefix} from")
        names = self.store.files(f"{self.target}/{prefix}")
        if not names:
            raise FileNotFoundError(f"{self.target}/{prefix}")
        for name in names:
            here = f"{into.rstrip('/')}/{name}"
            if not self.store.exists(here) or not self.store.size(here)[1]:
                self.store.copy(f"{self.target}/{prefix}/{name}", here)
        return [f"{into.rstrip('/')}/{name}" for name in names]

    def chunks(self, prefix: str) -> set[int]:
        """Start rows of the chunks published under a prefix."""
        if not self.target:
            raise FileNotFoundError("no publishing target to list chunks of")
        return {int(n[6:]) for n in self.store.names(f"{self.target}/{prefix}") if n.startswith("chunk=") and n[6:].isdigit()}


def counts(stage: DataFrame, final: DataFrame) -> dict[str, int]:
    """Survivors of the filters, final documents and what near-duplicate removal took."""
    a, b = stage.count(), final.count()
    return {"survivors": a, "final": b, "removed": a - b}


def with_chunk(indexed: DataFrame, size: int, start: int = 0) -> DataFrame:
    """Numbered rows from `start` with the start row of their chunk."""
    i = F.col("row_idx")
    return indexed.where(i >= start).withColumn("chunk", (F.floor((i - start) / F.lit(size)) * size + start).cast("bigint"))
