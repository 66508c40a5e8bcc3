"""Continuous landing of files and of deduplicated payments."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tallyspark import schemas as S
from tallyspark.operators.staging import PAYMENT_IDENTITY, dedupe_payments
from tallyspark.sources.landing import as_text, csv_options, typed_rows
from tallyspark.sources.tables import insert_if_absent, overwrite_partitions


def first_file_rows(batch: DataFrame, keys: Sequence[str], file: str) -> DataFrame:
    """The rows of each key that come from the earliest file (a struct of time and path) with it.

    Copies of a key inside one file all stay, and so do rows whose key has a NULL part.
    """
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    first = batch.where(whole).groupBy(*keys).agg(F.min(file).alias("_first"))
    return (batch.join(first, list(keys), "left")
            .where(F.col("_first").isNull() | (F.col(file) == F.col("_first"))).drop("_first"))


def batch_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """A name for a batch that stays the same when it is replayed, and that no other query uses.

    The query's own id is in its checkpoint: a new checkpoint counts its batches anew under a new id.
    """
    query = spark.read.schema("id string").json(f"{checkpoint}/metadata").first()
    return f"{query.id}-{batch_id:09d}"


def stream_landing(spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str],
                   target: str, checkpoint: str, partition_by: Sequence[str] = (),
                   max_files: int | None = None, multi_line: bool = False,
                   prune: Sequence[str] = ()) -> StreamingQuery:
    """Land new CSV files under ``folder`` into the table at ``target``, known keys skipped.

    Runs until the present files are taken. Files count by their time of change, and those of one
    time by their path: a key's rows come from the first file that has it, however files fall into
    batches. The checkpoint remembers taken files; a batch that is replayed after a failure
    replaces the rows it landed before, in the folder of its own number (``insert_if_absent``).
    Rows of the wrong length are an error, as in ``read_landing_csv``; ``prune`` as in
    ``insert_if_absent``.
    """
    reader = spark.readStream.schema(as_text(schema)).options(**csv_options(multi_line))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    file = F.struct("_metadata.file_modification_time", "_metadata.file_path")
    rows = reader.csv(folder).withColumn("_file", file)

    def land(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            typed = typed_rows(batch, schema, "_file")
            insert_if_absent(batch.sparkSession, target,
                             first_file_rows(typed, keys, "_file").select(*schema.fieldNames()),
                             keys, partition_by=partition_by, prune=prune,
                             batch=batch_name(batch.sparkSession, checkpoint, batch_id))
        finally:
            batch.unpersist()

    return (rows.writeStream.foreachBatch(land)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def payment_bucket(buckets: int) -> Column:
    """The bucket of a payment: copies share it, NULLs in the identity count as equal."""
    return F.pmod(F.xxhash64(*PAYMENT_IDENTITY), F.lit(buckets)).cast("int")


def stream_payments_staging(spark: SparkSession, raw: str, target: str, checkpoint: str,
                            grain: str = "day", max_files: int | None = None,
                            buckets: int = 16) -> StreamingQuery:
    """Keep staged payments in step with the landed payments at ``raw``.

    The staged table is partitioned by ``period``, the day or month of the payment, and within it
    by ``bucket``, a hash of what makes two payments copies of one. Copies share both, so each batch
    rebuilds the buckets it touches, and those alone, from the landed rows of their periods. A copy
    with a lower id arriving later wins as it would in a full rebuild, and a replayed batch writes
    the same rows again, whatever a failure left of them. The number of buckets of a table is fixed.
    """
    schema = S.with_loaded_at(S.LANDED["payments"])
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    day = F.col("payment_date")
    place = {"period": F.date_trunc(grain, day).cast("date"), "bucket": payment_bucket(buckets)}

    def rebuild(batch: DataFrame, _batch_id: int) -> None:
        touched = batch.select(*[c.alias(f"_{n}") for n, c in place.items()]).distinct().persist()
        try:
            first, last, undated = touched.agg(
                F.min("_period"), F.max("_period"), F.bool_or(F.col("_period").isNull())).first()
            after_last = F.lit(last).cast("date") + F.expr(f"interval 1 {grain}")
            landed = batch.sparkSession.read.schema(schema).parquet(raw)
            # The range reaches the scan; rows without a date form a period of their own.
            near = (day >= F.lit(first)) & (day < after_last)
            landed = landed.where(near | day.isNull() if undated else near).withColumns(place)
            # At most the days of the calendar times the buckets.
            mine = landed.join(
                F.broadcast(touched), F.col("period").eqNullSafe(F.col("_period"))
                & (F.col("bucket") == F.col("_bucket")), "left_semi")
            staged = dedupe_payments(mine.select(*schema.fieldNames()))
            overwrite_partitions(staged.withColumns(place), target, list(place))
        finally:
            touched.unpersist()

    return (reader.parquet(raw).writeStream.foreachBatch(rebuild)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
