"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "corpusprep") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CORPUSPREP_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def pin_utc(spark: SparkSession) -> SparkSession:
    """All calendar arithmetic here is in UTC; a session in another zone would move day boundaries."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session without one (tests, a laptop) gets a folder of its own; on a cluster a folder of one machine
    would be invisible to the others.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="corpusprep-")
        context.setCheckpointDir(configured)
    elif not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, so that reruns never see old files."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Removes a query's shuffle files when it ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries inside go when their query ends."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


#: Row groups of rows of many MB. Sizes are looked at after every row, not after a hundred, so that neither the writer nor
#: the reader, which takes a row group of a nested column at a time, holds many of them.
WIDE_ROWS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}


def put(df: DataFrame, path: str, mode: str = "errorifexists", options: dict | None = None) -> None:
    """Write Parquet that takes little room and leaves no shuffle files."""
    with shuffles_removed(df.sparkSession):
        df.write.mode(mode).options(**(options or {})).option("compression", "zstd").parquet(path)


def staged(df: DataFrame, stage: str | None, name: str) -> DataFrame:
    """Write the step to the stage folder and read it back; later steps then read only the columns they need."""
    if stage is None:
        return df
    path = f"{stage.rstrip('/')}/{name}"
    put(df, path, "overwrite")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders of intermediate results that nothing reads any more; a folder may be missing."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame) -> DataFrame:
    """Store an intermediate result reliably, cutting its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition an input that has fewer splits than the cluster has cores, for work heavy on the processor.

    A large table has more splits than cores and is left as it is: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
