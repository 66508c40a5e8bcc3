"""Reading landed files and cutting daily slices."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for NULL, and the date and time formats of the files.
NULL_TEXTS = ("", "NULL", "null")
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _typed(name: str, dtype: T.DataType) -> Column:
    text = F.when(~F.col(name).isin(*NULL_TEXTS), F.col(name))
    if isinstance(dtype, T.DateType):
        return F.to_date(text, DATE_FORMAT)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_timestamp(text, TIMESTAMP_FORMAT).cast(dtype)
    if isinstance(dtype, T.LongType):
        return F.round(text.cast("decimal(38,6)")).cast(dtype)
    return text.cast(dtype)


def as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def typed_rows(text_rows: DataFrame, schema: T.StructType, *others: str) -> DataFrame:
    """Text columns as the types of ``schema``, with the NULL texts mapped first; ``others`` stay."""
    return text_rows.select(*[_typed(f.name, f.dataType).alias(f.name) for f in schema.fields],
                            *others)


def csv_options(multi_line: bool = False) -> dict[str, str]:
    """Pruned columns would hide rows of the wrong length, so every column is parsed."""
    return {"header": "true", "sep": ",", "quote": '"', "escape": '"', "mode": "FAILFAST",
            "columnPruning": "false", "multiLine": str(multi_line).lower()}


def read_landing_csv(spark: SparkSession, path: str, schema: T.StructType,
                     multi_line: bool = False) -> DataFrame:
    """Comma-separated files with a header row; columns are taken by position.

    A text that does not fit its type, and a row with too few or too many columns, is an error,
    also where only some columns are asked for. A fraction in a column of whole numbers is rounded,
    halves away from zero. ``multi_line`` reads line breaks inside quotes, at the price of one task
    per file; without it a row that a break cuts is an error.
    """
    rows = spark.read.schema(as_text(schema)).options(**csv_options(multi_line)).csv(path)
    return typed_rows(rows, schema)


def read_landing_json(spark: SparkSession, path: str, schema: T.StructType,
                      outer_array: bool = True) -> DataFrame:
    """JSON files holding one outer array of objects, or one object per line.

    An array file is read by one task; files of one object per line are split.
    """
    return (spark.read.schema(schema).option("multiLine", outer_array)
            .option("mode", "FAILFAST").json(path))


def list_staged(spark: SparkSession, path: str) -> DataFrame:
    """Staged files with size and change time; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select(F.col("path").alias("file_path"), F.col("length").alias("size_bytes"),
                    F.col("modificationTime").alias("modified_at")))


def not_yet_loaded(staged: DataFrame, loaded: DataFrame) -> DataFrame:
    """Staged files whose path is not among the loaded ones."""
    return staged.join(loaded.select("file_path").distinct(), "file_path", "left_anti")


def daily_slice(df: DataFrame, landing_column: str, run_date: date | str) -> DataFrame:
    """Rows that landed on one day; a plain date comparison, so it reaches the scan."""
    day = F.lit(str(run_date)).cast("date")
    if isinstance(df.schema[landing_column].dataType, T.DateType):
        return df.where(F.col(landing_column) == day)
    return df.where((F.col(landing_column) >= day)
                    & (F.col(landing_column) < F.date_add(day, 1)))


def daily_slice_child(child: DataFrame, parent_slice: DataFrame, key: str) -> DataFrame:
    """Child rows whose parent is in the slice of the day."""
    return child.join(parent_slice.select(key), key, "left_semi")


def feed_arrived(spark: SparkSession, folder: str, run_date: date | str,
                 tables: Sequence[str]) -> bool:
    """Whether any of the tables has a file for the day; an absent folder means not yet."""
    pattern = f"{folder}/{run_date}/{{{','.join(tables)}}}/*.csv"
    try:
        return not list_staged(spark, pattern).isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
