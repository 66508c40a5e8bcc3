"""Order-dependent scans that never put a whole key into one task.

A plain window over a key sorts all rows of that key in one task. Here each key is cut into
ranges along the sort order. A first pass scans inside the ranges; a second pass carries one
summary row per range across range borders. The result equals the plain window, while a key
holding a large share of the rows is spread over as many tasks as it has ranges.

``ordinals`` numbers a whole table the same way: ranges are sorted each in a task of its own, and
only their sizes are added up in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.session import shuffles_dropped, stage_table

RANGE_WIDTH = 4096
HOT_ROWS = 1_000_000


def _range_of(order: str, width: int) -> Column:
    return F.floor(F.col(order) / F.lit(width))


def _spread(keys: Sequence[str], *part: str) -> Window:
    return Window.partitionBy(*keys, *part)


def with_next(df: DataFrame, keys: Sequence[str], order: str, value: str, into: str,
              is_last: str | None = None, width: int = RANGE_WIDTH) -> DataFrame:
    """``into`` = ``value`` of the row that follows in ``order`` within the key, else NULL.

    ``order`` is a whole-number column; NULL sorts last. ``is_last`` names an optional flag for
    rows without a follower, which tells a missing follower from one whose value is NULL.
    """
    cut = df.withColumn("_range", F.coalesce(_range_of(order, width), F.lit(2**62)))
    position = F.struct(F.col(order).isNull(), F.col(order), F.col(value))
    cell = F.struct(F.col(value).alias("v"))
    inside_range = _spread(keys, "_range").orderBy(position)
    # Both parts below need every column, so they share one exchange and one scan.
    seen = cut.withColumns({"_next": F.lead(cell).over(inside_range),
                            "_opens": F.lag(F.lit(True)).over(inside_range).isNull()})
    within = seen.where("_next IS NOT NULL")
    # The first and last row of each range: what follows a last one is the next range's first.
    border = Window.partitionBy(*keys).orderBy("_range", position)
    across = (seen.where("_next IS NULL OR _opens")
              .withColumn("_after", F.lead(cell).over(border))
              .where("_next IS NULL").drop("_next").withColumnRenamed("_after", "_next"))
    follower = F.col("_next")
    columns = [*[F.col(c) for c in df.columns], follower["v"].alias(into)]
    if is_last:
        columns.append(follower.isNull().alias(is_last))
    return within.select(*columns).unionByName(across.select(*columns))


def with_running_count(df: DataFrame, keys: Sequence[str], order: str, condition: Column,
                       into: str, width: int = RANGE_WIDTH) -> DataFrame:
    """Number of rows up to and including this one, in ``order``, that meet ``condition``."""
    hit = condition.cast("long")
    cut = df.withColumn("_range", _range_of(order, width))
    upto = _spread(keys, "_range").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    inside = cut.withColumn("_inside", F.sum(hit).over(upto))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy(*keys, "_range").agg(F.sum(hit).alias("_sum"))
        .select(*keys, "_range", F.sum("_sum").over(before).alias("_before"))
        .where("_before is not null")
    )
    return inside.join(carried, [*keys, "_range"], "left").select(
        *df.columns, (F.col("_inside") + F.coalesce("_before", F.lit(0))).alias(into))


def with_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], into: str,
              total: str | None = None, hot_rows: int = HOT_ROWS,
              range_columns: int = 1) -> DataFrame:
    """``into`` = row number by ``order`` within the key, ``total`` = rows of the key.

    Keys with more than ``hot_rows`` rows are cut along the first ``range_columns`` order columns.
    There are at most (all rows / ``hot_rows``) such keys, which bounds the broadcast of them.
    """
    hot = (df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows)
           .select(*keys, F.lit(True).alias("_hot")))
    with shuffles_dropped(df.sparkSession):
        none_hot = hot.isEmpty()
    if none_hot:
        # The usual case: one shuffle by the key alone, which what follows can go on with.
        own = _spread(keys)
        ranked = [*[F.col(c) for c in df.columns],
                  F.row_number().over(own.orderBy(*order)).cast("long").alias(into)]
        if total:
            ranked.append(F.count("*").over(own).alias(total))
        return df.select(*ranked)
    cut = (df.join(F.broadcast(hot), list(keys), "left")
           .withColumn("_range", F.when(F.col("_hot"), F.struct(*order[:range_columns]))))
    local = _spread(keys, "_range")
    inside = (cut.withColumn("_inside", F.row_number().over(local.orderBy(*order)))
              .withColumn("_local_total", F.count("*").over(local)))
    by_key = Window.partitionBy(*keys)
    carried = (
        cut.where("_hot").groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
        .select(*keys, "_range",
                F.sum("_n").over(by_key.orderBy("_range").rowsBetween(
                    Window.unboundedPreceding, -1)).alias("_before"),
                F.sum("_n").over(by_key).alias("_total"))
    )
    joined = inside.join(carried, [*keys, "_range"], "left")
    columns = [*[F.col(c) for c in df.columns],
               (F.col("_inside") + F.coalesce("_before", F.lit(0))).alias(into)]
    if total:
        columns.append(F.coalesce("_total", "_local_total").alias(total))
    return joined.select(*columns)


def ordinals(df: DataFrame, *order: Column, into: str) -> DataFrame:
    """The rows in ranges of ``order``, with ``into`` = 1, 2, 3 and on.

    The ranges are written sorted; each row's place in its range comes from the number that Spark
    gives it there. The sizes of the ranges, one for each task, are all that is fetched.
    """
    bits = 33
    placed = stage_table(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
            into, F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(into, bits)
    sizes = {r[0]: r[1] for r in placed.groupBy(part).count().collect()}
    before, done = {}, 1
    for number in sorted(sizes):
        before[number], done = done, done + sizes[number]
    if not before:
        return placed
    starts = F.create_map(*[F.lit(x).cast("long") for pair in before.items() for x in pair])
    inside = F.col(into).bitwiseAND((1 << bits) - 1)
    return placed.withColumn(into, F.element_at(starts, part) + inside)
