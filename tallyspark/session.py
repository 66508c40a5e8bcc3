"""Spark session settings and the shared working folder for materialised intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.sources.files import delete_folder

_local_folders: dict[str, str] = {}
_staged: list[list[str]] = []


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """A session with the settings the operators rely on: UTC, AQE, ANSI arithmetic.

    On a cluster leave every argument unset; master, memory and initial shuffle parallelism come
    from the submit configuration, and AQE coalesces the shuffle partitions to what is needed.
    """
    builder = (
        SparkSession.builder.appName("tallyspark")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Version rows expand into months after their shuffle: a small input is no small stage.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()


def working_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is absent a local folder is made, which only a local master can share with
    its executors; on a cluster the missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tallyspark-")
    return _local_folders[app]


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries started inside leave no shuffle files.

    Otherwise these stay until the driver happens to collect its garbage, and a chain of staged
    tables holds the shuffles of all its steps on disk. Later queries keep the session's setting.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stage_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Cuts lineage in a way that survives lost executors, and gives Catalyst the real size of the
    data, so its own threshold decides which joins may broadcast it. A table that is partitioned is
    gathered by partition first, and a filter on its columns chooses folders.
    """
    path = f"{working_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    for area in _staged:
        area.append(path)
    gathered = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    with shuffles_dropped(df.sparkSession):
        gathered.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    return written.select(*df.columns) if partition_by else written


@contextmanager
def staging_area(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was staged inside. Results must be written elsewhere before.

    Nothing is deleted where the work inside fails, so that it can be looked at.
    """
    area: list[str] = []
    _staged.append(area)
    try:
        yield
    finally:
        _staged.remove(area)
    for path in area:
        delete_folder(spark, path)
