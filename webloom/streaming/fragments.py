"""Incremental manifest: new fragments of the index as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from webloom.operators.manifest import wanted
from webloom.plans.profile import GREEK, Profile


def new_records(spark: SparkSession, folder: str, schema: str, profile: Profile = GREEK, delay: str = "60 days") -> DataFrame:
    """Selected records of fragments as they arrive, each digest once within the delay (by fetch_time, which must be in the schema)."""
    index = spark.readStream.schema(schema).parquet(folder)
    return wanted(index, profile).withWatermark("fetch_time", delay).dropDuplicatesWithinWatermark(["content_digest"])


def run_available(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Take in what is there and stop; the next run goes on from the checkpoint."""
    query = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
