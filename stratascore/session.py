"""Session set-up and the one place that decides where shared scratch data goes."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "stratascore", cpus: int | str = "*", memory: str = "12g", scratch: str | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster the submitter builds its own.

    ``scratch`` is the shared folder for intermediate tables.
    """
    builder = SparkSession.builder if scratch is None else SparkSession.builder.config(CHECKPOINT_CONF, scratch)
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, only a local master gets a folder of its own, which goes when Python ends: on a
    cluster the executors would each write to their own disk and the data would go with the machine.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="stratascore-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set(CHECKPOINT_CONF, root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; every call gives a new one."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df, name: str, partition_by: str | None = None):
    """Write ``df`` to the shared folder and read it back, which cuts the lineage for good."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def folder_of(table: DataFrame) -> str:
    """The scratch folder behind a table from ``materialize``."""
    root = scratch_root(table.sparkSession).split(":", 1)[-1].rstrip("/")
    parts = [f.split(":", 1)[-1] for f in table.inputFiles()]
    inside = {re.sub("^/+", "/", f).removeprefix(re.sub("^/+", "/", root)).lstrip("/").split("/")[0] for f in parts}
    if len(inside) != 1:
        raise ValueError("not one scratch table")
    return f"{scratch_root(table.sparkSession)}/{inside.pop()}"


def release(*tables: DataFrame) -> None:
    """Delete tables from ``materialize`` once all that reads them has run."""
    for table in tables:
        if table.inputFiles():
            drop_path(table.sparkSession, folder_of(table))


@contextmanager
def kept_between_passes(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a narrow table for aggregates that read it several times; lost blocks are recomputed.

    A table in fewer partitions than the session works at once is spread. For sums and counts alone:
    what depends on the order of rows takes ``laid_out``.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    spread = None
    try:
        kept.count()
        wanted = df.sparkSession.sparkContext.defaultParallelism
        if kept.rdd.getNumPartitions() < wanted:
            spread = kept.repartition(wanted).persist(StorageLevel.MEMORY_AND_DISK)
        yield kept if spread is None else spread
    finally:
        if spread is not None:
            spread.unpersist()
        kept.unpersist()


ROWS_PER_PART = 1 << 20  # of the table of a seeded fit
LEAST_PARTS = 4


def fit_partitions(n: int) -> int:
    """Parts of the table of a seeded fit: a power of two at about ``ROWS_PER_PART`` rows a part, whatever the cluster."""
    return max(LEAST_PARTS, 1 << max(0, (n - 1) // ROWS_PER_PART).bit_length())


def laid_out(df: DataFrame, by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` in hash partitions by the columns, sorted by them inside; None takes ``fit_partitions`` of its rows.

    Seeded fits draw by partition and position. In this layout the draw depends on the rows and on
    their number, not on how the table came or on the number of cores.
    """
    parts = fit_partitions(df.count()) if partitions is None else partitions
    return df.repartition(parts, *[F.xxhash64(c) for c in by]).sortWithinPartitions(*by)
