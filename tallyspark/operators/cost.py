"""Warehouse cost by pipeline layer and day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.functions.scalar import as_of_timestamp, days_before, guarded_divide

TAG_FIELDS = {"app": "app", "project": "project", "target": "dbt_target",
              "schema": "pipeline_layer", "model": "dbt_model"}


def parse_query_tag(df: DataFrame, tag: str = "query_tag") -> DataFrame:
    """Adds the tag's fields as text columns; malformed JSON leaves them NULL."""
    parsed = df.withColumn("_tag", F.try_parse_json(tag))
    return parsed.select("*", *[
        F.try_variant_get("_tag", f"$.{field}", "string").alias(name)
        for field, name in TAG_FIELDS.items()]).drop("_tag")


def cost_by_layer_daily(query_history: DataFrame, warehouse_metering: DataFrame,
                        warehouses: Sequence[str] = S.WAREHOUSES,
                        days: int = S.COST_WINDOW_DAYS,
                        as_of: date | str | None = None) -> DataFrame:
    """Credits of each warehouse and day, shared among its tagged queries by elapsed time.

    The day totals have at most (named warehouses) x (days in the window) rows, which is small
    enough to broadcast however long the query history is.
    """
    since = days_before(as_of_timestamp(as_of), days)
    ours = F.col("warehouse_name").isin(*warehouses) & (F.col("start_time") >= since)
    day = F.to_date("start_time").alias("query_date")
    tagged = query_history.where(ours & F.col("query_tag").isNotNull()
                                 & (F.col("query_tag") != ""))
    by_day = ["query_date", "warehouse_name"]
    totals = tagged.groupBy(day, "warehouse_name").agg(
        F.sum("total_elapsed_time").alias("_day_elapsed_ms"))
    credits = warehouse_metering.where(ours).groupBy(day, "warehouse_name").agg(
        F.sum("credits_used").alias("_day_credits"))
    per_day = totals.join(credits, by_day, "left")
    steps = parse_query_tag(tagged).groupBy(
        day, "warehouse_name",
        F.coalesce("pipeline_layer", F.lit("invocation_level")).alias("pipeline_layer"),
        "dbt_model", "dbt_target",
    ).agg(F.count("*").alias("query_count"), F.sum("total_elapsed_time").alias("elapsed_ms"))
    # Widths that leave the quotient enough digits to be rounded once.
    weighted = (F.col("elapsed_ms").cast("decimal(18,0)")
                * F.coalesce("_day_credits", F.lit(0)).cast(S.UNIT_PRICE)).cast("decimal(24,4)")
    share = guarded_divide(weighted, F.col("_day_elapsed_ms").cast("decimal(18,0)"))
    return steps.join(F.broadcast(per_day), by_day, "left").select(
        *by_day, "pipeline_layer", "dbt_model", "dbt_target", "query_count", "elapsed_ms",
        F.round(share, 4).alias("estimated_credits"))
