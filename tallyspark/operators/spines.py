"""Regular time axes whose bounds come from the data."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.scalar import month_end


def date_bounds(sources: Iterable[tuple[DataFrame, str]]) -> DataFrame:
    """One row: the first and last date over all (table, date column) pairs."""
    dates = reduce(DataFrame.unionAll, [df.select(F.col(c).alias("d")) for df, c in sources])
    return dates.agg(F.min("d").alias("min_date"), F.max("d").alias("max_date"))


def date_spine_daily(sources: Iterable[tuple[DataFrame, str]]) -> DataFrame:
    """One row per calendar day, both bounds included."""
    return date_bounds(sources).select(
        F.explode(F.sequence("min_date", "max_date")).alias("date_day"))


def date_spine_between(spark: SparkSession, first: date, last: date) -> DataFrame:
    """The same spine from known bounds; nothing is scanned to build it."""
    return spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date_day"))


def month_end_spine(daily: DataFrame) -> DataFrame:
    """Month ends that lie within the daily spine; a trailing open month has none."""
    last_day: Column = daily.agg(F.max("date_day")).scalar()
    return (daily.select(month_end("date_day").alias("month_end_date")).distinct()
            .where(F.col("month_end_date") <= last_day))
