"""Movement types and the account and company waterfalls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.functions.scalar import surrogate_key

MEASURES = ("new", "expansion", "contraction", "churn", "reactivation")
MOVEMENTS = tuple(f"{m}_arr_usd" for m in MEASURES)


def classify_movement() -> Column:
    """Movement type of a bridge row; the first matching rule decides.

    The first month of a contract is judged by what its account had, later months by the amounts.
    """
    first = F.col("contract_month_seq") == 1
    account_at_zero = F.col("prior_account_arr_usd") == 0
    returning = F.col("account_ever_had_arr_before")
    real = F.col("real_component_usd")
    return (
        F.when(first & account_at_zero & ~returning, "new")
        .when(first & account_at_zero & returning, "reactivation")
        .when(first, "expansion")
        .when((F.col("arr_usd") == 0) & (F.col("prior_arr_usd_filled") > 0), "churn")
        .when(real > 0, "expansion")
        .when(real < 0, "contraction")
        .otherwise("no_change")
    )


def arr_movements(bridge: DataFrame) -> DataFrame:
    """One classified row per contract and month."""
    return bridge.select(
        surrogate_key("contract_id", "month_end_date").alias("arr_movement_sk"),
        "month_end_date", "contract_id", "account_id", "region", "legal_entity", "segment",
        "currency", "arr_local", "arr_usd", F.col("prior_arr_usd_filled").alias("prior_arr_usd"),
        "real_component_usd", "fx_component_usd", classify_movement().alias("movement_type"))


def movement_measures(movements: DataFrame) -> DataFrame:
    """The waterfall measures of each single movement; every waterfall is a sum of these."""
    real, zero = F.col("real_component_usd"), F.lit(0).cast(S.MONEY)
    return movements.select(
        "month_end_date", "account_id", "region", "legal_entity", "segment",
        F.col("arr_usd").alias("account_arr_usd"),
        *[F.when(F.col("movement_type") == m, real).otherwise(zero).alias(f"{m}_arr_usd")
          for m in MEASURES],
        F.col("fx_component_usd").alias("fx_impact_usd"))


def waterfall_account(movements: DataFrame) -> DataFrame:
    """Movements netted to one row per account and month."""
    return movement_measures(movements).groupBy(
        "month_end_date", "account_id", "region", "legal_entity", "segment",
    ).agg(*[F.sum(c).alias(c) for c in ("account_arr_usd", *MOVEMENTS, "fx_impact_usd")])


def net_movement() -> Column:
    total = F.col("fx_impact_usd")
    for name in MOVEMENTS:
        total = total + F.col(name)
    return total


def waterfall_portfolio(measures: DataFrame) -> DataFrame:
    """Company-wide total and bridge per month, from an account waterfall or its measures.

    Summing the measures of single movements gives the same totals as summing accounts, without
    shuffling one row per account and month. The lag has no partition key; it runs over one row
    per month, after the aggregation.
    """
    monthly = measures.groupBy("month_end_date").agg(
        F.sum("account_arr_usd").alias("total_arr_usd"),
        *[F.sum(c).alias(c) for c in (*MOVEMENTS, "fx_impact_usd")])
    over_time = Window.orderBy("month_end_date")
    return monthly.select(
        "month_end_date", "total_arr_usd",
        F.lag("total_arr_usd").over(over_time).alias("prior_total_arr_usd"),
        *MOVEMENTS, "fx_impact_usd", net_movement().alias("net_movement_usd"))
