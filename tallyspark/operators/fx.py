"""Gap-free daily FX rates and conversion to the base currency.

A rate is units of the quote currency per one unit of the base currency, so local amounts are
divided by it. The filled table has (days of the calendar window) x (currencies) rows, whatever
the number of facts: tens of thousands of rows for decades of history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.functions.scalar import fill_backward, fill_forward, guarded_divide


BROADCAST_ROWS = 1_000_000


def fx_daily_filled(daily: DataFrame, rates: DataFrame,
                    currencies: Sequence[str] = S.CURRENCIES) -> DataFrame:
    """One rate per day and currency: the last known one, else the first one to come."""
    grid = daily.select(
        F.col("date_day").alias("rate_date"),
        F.explode(F.array(*[F.lit(c) for c in currencies])).alias("quote_currency"))
    observed = rates.select("rate_date", "quote_currency", F.col("fx_rate").alias("_observed"))
    by_currency = (["quote_currency"], "rate_date")
    return grid.join(observed, ["rate_date", "quote_currency"], "left").select(
        "rate_date", "quote_currency",
        F.coalesce(fill_forward("_observed", *by_currency),
                   fill_backward("_observed", *by_currency)).alias("fx_rate"),
        F.col("_observed").isNull().alias("is_fx_rate_filled"))


def broadcast_rates(fx: DataFrame, days: int, currencies: Sequence[str] = S.CURRENCIES,
                    row_limit: int = BROADCAST_ROWS) -> DataFrame:
    """Marks filled rates for broadcast where the calendar window keeps them below ``row_limit``.

    Without the mark, a cluster with automatic broadcasts turned off would shuffle every fact by
    day and currency, onto a few thousand very uneven keys. Beyond the limit the join is left to
    Spark, whose adaptive skew handling splits such keys.
    """
    return F.broadcast(fx) if days * len(currencies) <= row_limit else fx


def rate_on(df: DataFrame, fx: DataFrame, day: str, currency: Column | str, into: str) -> DataFrame:
    """Adds the rate of ``day`` and ``currency``; NULL where the spine has no such day."""
    currency = F.col(currency) if isinstance(currency, str) else currency
    rates = fx.select(F.col("rate_date").alias("_day"), F.col("quote_currency").alias("_currency"),
                      F.col("fx_rate").alias(into))
    return df.join(rates, (F.col(day) == F.col("_day")) & (currency == F.col("_currency")),
                   "left").drop("_day", "_currency")


def to_usd(df: DataFrame, fx: DataFrame, day: str, amount: str = "amount",
           currency: str = "currency", into: str = "amount_usd") -> DataFrame:
    """Adds ``amount`` in the base currency at the rate of its own day, unrounded."""
    return (rate_on(df, fx, day, currency, "_rate")
            .withColumn(into, guarded_divide(amount, "_rate")).drop("_rate"))
