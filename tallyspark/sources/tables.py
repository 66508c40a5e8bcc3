"""Table sinks: insert-if-absent, full rebuild, key replacement, append, export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas as S
from tallyspark.sources.landing import daily_slice, daily_slice_child


#: The folder of a batch that may be landed again.
BATCH = "landed_batch"


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table of the same structure."""
    return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The parquet table at ``path``, or an empty one where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_like(spark, schema)


def absent_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose key is not in ``target``.

    Known keys are first looked up by the keys of the batch, so a small batch meets a large table
    in a map-side join, without a shuffle of the table. A key with a NULL part is never known.
    """
    keys = list(keys)
    known = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    return source.join(known, keys, "left_anti")


def _gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one partition brought together for writing; AQE splits a partition that is large."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def within_range(target: DataFrame, source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``target`` cut to the range of values that ``source`` has in each column, as literals.

    They reach the scan, and choose its partitions where the table is partitioned by the column.
    """
    if not columns:
        return target
    ends = source.agg(*[f(F.col(c)).alias(f"{n}_{c}") for c in columns
                        for f, n in ((F.min, "min"), (F.max, "max"))],
                      *[F.bool_or(F.col(c).isNull()).alias(f"null_{c}") for c in columns]).first()
    for c in columns:
        near = F.col(c).between(F.lit(ends[f"min_{c}"]), F.lit(ends[f"max_{c}"]))
        target = target.where(near | F.col(c).isNull() if ends[f"null_{c}"] else near)
    return target


def insert_if_absent(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                     loaded_at: Column | None = None, partition_by: Sequence[str] = (),
                     prune: Sequence[str] = (), batch: str | None = None) -> None:
    """Append the rows with a new key, stamped with the load time. Known keys stay as they are.

    ``prune`` names columns that a key determines: the table is only searched where their values
    lie in the range of ``source``. Such a key must never come with two values of the column.

    ``batch`` names a delivery that may come again after a failure. Its rows get a folder of that
    name, which is also the table's column ``BATCH``; landed again, it replaces its own rows,
    those with a NULL key part included, and nothing else. A table is landed with names throughout
    or without.
    """
    schema = S.with_loaded_at(source.schema)
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    source = source.persist()
    try:
        if batch is not None:
            schema = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
        target = read_table(spark, path, schema)
        if batch is not None:
            target = target.where(F.col(BATCH) != batch)
        target = within_range(target, source, prune)
        fresh = absent_rows(target, source, keys).withColumn(
            S.LOADED_AT, stamp.cast("timestamp_ntz"))
        write = _gathered(fresh, partition_by).write.partitionBy(*partition_by)
        if batch is None:
            write.mode("append").parquet(path)
        else:
            write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
                f"{path}/{BATCH}={batch}")
    finally:
        source.unpersist()


def write_mart(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Rebuild a mart table in full."""
    _gathered(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_keys(current: DataFrame, recomputed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``current`` without the keys of ``recomputed``, plus ``recomputed``.

    Keys match by equality: rows of ``current`` with a NULL key part are kept.
    """
    touched = recomputed.select(*keys).distinct()
    return current.join(touched, list(keys), "left_anti").unionByName(recomputed)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions that occur in ``df``; all others stay untouched."""
    (_gathered(df, partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def _write_csv(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").options(header=True, escape='"', ignoreLeadingWhiteSpace=False,
                                        ignoreTrailingWhiteSpace=False).csv(path))


def write_backfill(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Full history as CSV, one folder per table, load times left out."""
    for name, df in tables.items():
        _write_csv(df.drop(S.LOADED_AT), f"{folder}/{name}")


def write_daily(tables: Mapping[str, DataFrame], run_date: date | str, folder: str) -> list[str]:
    """One day of every table as CSV under the folder of the day; empty slices are not written."""
    slices = {name: daily_slice(df, S.LANDING_DATE[name], run_date)
              for name, df in tables.items() if name in S.LANDING_DATE}
    if "invoices" in slices and "invoice_line_items" in tables:
        slices["invoice_line_items"] = daily_slice_child(
            tables["invoice_line_items"], slices["invoices"], "invoice_id")
    written = []
    for name, df in slices.items():
        if not df.isEmpty():
            _write_csv(df.drop(S.LOADED_AT), f"{folder}/{run_date}/{name}")
            written.append(name)
    return written
