"""Places of rows in a total order, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.session import stage_table

_BITS = 33


def ranked(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` with ``rank``, ascending by the given columns, nulls first; ranks have gaps.

    Ranges of rows are sorted, each in a task of its own, and numbered within it.
    """
    return stage_table(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(
        "rank", F.monotonically_increasing_id()), "ranked")


def ordinals(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` with ``ordinal``: 0, 1, 2 and on by the given columns.

    Only each range's number of rows meets the others', in one task.
    """
    placed = ranked(rows, *by)
    part = F.shiftright("rank", _BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n"))
                          .alias("before"))
    return placed.withColumn("part", part).join(F.broadcast(before), "part").withColumn(
        "ordinal", F.col("before") + F.col("rank").bitwiseAND((1 << _BITS) - 1)).drop(
            "part", "before", "rank")


def successors(keys: DataFrame) -> DataFrame:
    """Each distinct row of ``keys`` and, as ``next_`` columns, the one after it in ascending order.

    The last row's next is the first. Only each range's first and last rank meet in one task.
    """
    names = keys.columns
    rows = ranked(keys.distinct(), *names)
    ends = rows.groupBy(F.shiftright("rank", _BITS).alias("part")).agg(
        F.min("rank").alias("first"), F.max("rank").alias("rank"))
    ends = ends.select("rank", F.coalesce(
        F.lead("first").over(Window.orderBy("part")),
        F.min("first").over(Window.partitionBy())).alias("wrap"))
    numbered = rows.join(F.broadcast(ends), "rank", "left").withColumn(
        "next_rank", F.coalesce("wrap", F.col("rank") + 1))
    following = rows.select(F.col("rank").alias("next_rank"),
                            *[F.col(n).alias(f"next_{n}") for n in names])
    return numbered.join(following, "next_rank").select(*names, *[f"next_{n}" for n in names])
