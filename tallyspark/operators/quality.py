"""Data checks. Each returns the violating rows or groups; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.functions.scalar import as_of_timestamp
from tallyspark.operators.waterfall import net_movement

CENT = 0.01
DOLLAR = 1.00


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; NULLs do not count as equal."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n_records")).where("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Known values outside the accepted ones, with their count."""
    return (df.where(~F.col(column).isin(*values)).groupBy(column)
            .agg(F.count("*").alias("n_records")))


def relationships(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Known values without a parent, with their count.

    Counting before the join sends each value once, however often it occurs.
    """
    used = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count("*").alias("n_records"))
    return used.join(parent.select(F.col(field).alias(column)), column, "left_anti")


def freshness(df: DataFrame, loaded_at: str, warn_after: timedelta, error_after: timedelta,
              as_of: datetime | str | None = None) -> DataFrame:
    """One row: the newest load time, its age in seconds, and pass, warn or error."""
    newest = df.agg(F.max(loaded_at).cast("timestamp_ntz").alias("max_loaded_at"))
    age = F.unix_seconds(as_of_timestamp(as_of).cast("timestamp")) - F.unix_seconds(
        F.col("max_loaded_at").cast("timestamp"))
    status = (F.when(F.col("age_seconds").isNull(), "error")
              .when(F.col("age_seconds") > int(error_after.total_seconds()), "error")
              .when(F.col("age_seconds") > int(warn_after.total_seconds()), "warn")
              .otherwise("pass"))
    return newest.withColumn("age_seconds", age).withColumn("status", status)


def _gap(df: DataFrame, gap: Column, tolerance: float, *columns: str) -> DataFrame:
    limit = F.lit(str(tolerance)).cast(S.UNIT_PRICE)
    return (df.withColumn("_gap", gap).where(F.abs("_gap") > limit)
            .select(*columns, F.round("_gap", 2).alias("reconciliation_gap")))


def decomposition_gap(bridge: DataFrame, tolerance: float = CENT) -> DataFrame:
    """Contract months whose real and FX parts do not add up to the change."""
    gap = (F.col("arr_usd") - F.col("prior_arr_usd_filled") - F.col("real_component_usd")
           - F.col("fx_component_usd"))
    return _gap(bridge, gap, tolerance, "contract_id", "month_end_date", "arr_usd",
                "prior_arr_usd_filled", "real_component_usd", "fx_component_usd")


def _change_gap(df: DataFrame, total: str, prior: str) -> Column:
    return F.col(total) - F.coalesce(prior, F.lit(0)) - F.col("net_movement_usd")


def account_waterfall_gap(account_waterfall: DataFrame, tolerance: float = CENT) -> DataFrame:
    """Account months whose movements do not add up to the change."""
    history = Window.partitionBy("account_id").orderBy("month_end_date")
    df = account_waterfall.select(
        "account_id", "month_end_date", "account_arr_usd",
        F.lag("account_arr_usd").over(history).alias("prior_account_arr_usd"),
        net_movement().alias("net_movement_usd"))
    return _gap(df, _change_gap(df, "account_arr_usd", "prior_account_arr_usd"), tolerance,
                *df.columns)


def portfolio_waterfall_gap(portfolio: DataFrame, tolerance: float = CENT) -> DataFrame:
    """Months whose movements do not add up to the change of the company total."""
    return _gap(portfolio, _change_gap(portfolio, "total_arr_usd", "prior_total_arr_usd"),
                tolerance, "month_end_date", "total_arr_usd", "prior_total_arr_usd",
                "net_movement_usd")


def portfolio_vs_contract_gap(portfolio: DataFrame, contract_arr: DataFrame,
                              tolerance: float = CENT) -> DataFrame:
    """Months whose company total differs from the sum over contracts."""
    direct = contract_arr.groupBy("month_end_date").agg(
        F.sum("arr_usd").alias("contract_level_total_arr_usd"))
    both = portfolio.select(
        "month_end_date", F.col("total_arr_usd").alias("portfolio_total_arr_usd")
    ).join(direct, "month_end_date")
    gap = F.col("portfolio_total_arr_usd") - F.col("contract_level_total_arr_usd")
    return _gap(both, gap, tolerance, *both.columns)


def billed_vs_recognized_gap(reconciliation: DataFrame, tolerance: float = DOLLAR) -> DataFrame:
    """Keys where recognized revenue net of credits is not billed plus adjustments less credits."""
    gap = (F.col("recognized_net_of_credits_usd") - F.col("billed_usd")
           - F.col("manual_adjustment_usd") + F.col("credit_usd"))
    return _gap(reconciliation, gap, tolerance, "month_start", "legal_entity", "billed_usd",
                "manual_adjustment_usd", "credit_usd", "recognized_net_of_credits_usd")


def unconverted_facts(df: DataFrame, amount_usd: str = "amount_usd") -> DataFrame:
    """Facts with an amount that found no rate; they are missing from every USD sum."""
    return df.where(F.col("amount").isNotNull() & F.col(amount_usd).isNull())


def credit_memo_lag(credit_memos: DataFrame, late_after_days: int = 0) -> DataFrame:
    """Days between issue and system entry of each memo, and whether that is late."""
    lag = F.datediff("system_entry_date", "issue_date")
    return credit_memos.select(
        "credit_memo_id", "invoice_id", "issue_date", "system_entry_date",
        lag.alias("lag_days"), (lag > late_after_days).alias("is_late"))
