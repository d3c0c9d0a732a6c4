"""Session defaults, package shipping, lineage cutting and checked broadcasts."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
#: Set where a session leaves them open: rows of an Arrow batch, as a row may be a long text.
RUNTIME = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}
#: Rows of a few numbers each that may be broadcast.
SMALL_ROWS = 500_000


def build(app: str = "webloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; keyword settings override them."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Arrow functions import there."""
    sc = spark.sparkContext
    for k, v in RUNTIME.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    if getattr(sc, "_webloom_shipped", None) == sc.applicationId:
        return
    root = Path(__file__).resolve().parent
    fd, name = tempfile.mkstemp(prefix="webloom_", suffix=".zip")
    os.close(fd)
    atexit.register(Path(name).unlink, missing_ok=True)  # executors may ask for it as long as the application runs
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path(root.name) / p.relative_to(root)))
    sc.addPyFile(name)
    sc._webloom_shipped = sc.applicationId


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local master may do without: a folder of this machine is then used.

    On a cluster every node would write to its own disk, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named:
            if not (sc.master or "").startswith("local") or (sc.master or "").startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
            named = tempfile.mkdtemp(prefix="webloom_cp_")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder; its files go when no frame needs them any more."""
    spark = df.sparkSession
    shared_folder(spark)
    with contextlib.suppress(Exception):  # read when a checkpoint is made, so it may be set in a session that others built
        spark.sparkContext._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    return df.checkpoint(eager=True)


def small(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """The frame marked for broadcast if it has at most `most` rows, else as it is. It is counted, so give a cut one."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
