"""Dashboard tiles over the portfolio and account waterfalls."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.ordered import ordinals
from tallyspark.functions.scalar import latest, percent_change

# Bars of the bridge in display order, with the column each one shows.
BRIDGE = (
    ("Starting ARR", "prior_total_arr_usd"),
    ("New", "new_arr_usd"),
    ("Expansion", "expansion_arr_usd"),
    ("Reactivation", "reactivation_arr_usd"),
    ("Contraction", "contraction_arr_usd"),
    ("Churn", "churn_arr_usd"),
    ("FX Impact", "fx_impact_usd"),
    ("Ending ARR", "total_arr_usd"),
)
TREND = BRIDGE[1:6]


def in_order(report: DataFrame, *order: Column) -> DataFrame:
    """A report sorted, with each row's ``place`` from 1. Reports may be long: no task sees all
    rows. Rows equal in ``order`` get their places in any order."""
    return ordinals(report, *order, into="place").orderBy("place")


def headline_arr(portfolio: DataFrame) -> DataFrame:
    """Total of the latest month with its change to the month before, absolute and in percent."""
    return latest(portfolio, "month_end_date").select(
        "month_end_date", "total_arr_usd",
        (F.col("total_arr_usd") - F.col("prior_total_arr_usd")).alias("mom_change_usd"),
        percent_change("total_arr_usd", "prior_total_arr_usd").alias("mom_change_pct"))


def _bars(portfolio: DataFrame, amount_of) -> DataFrame:
    """The latest month as one row per bar: position, label, amount."""
    bars = [F.struct(F.lit(i).alias("position"), F.lit(label).alias("label"),
                     amount_of(column).alias("amount"))
            for i, (label, column) in enumerate(BRIDGE, start=1)]
    return latest(portfolio, "month_end_date").select(F.inline(F.array(*bars)))


def waterfall_bridge_tile(portfolio: DataFrame) -> DataFrame:
    """Floating bars: an invisible base and a visible part, ending with the total on the ground."""
    def amount_of(column: str) -> Column:
        known = F.col(column)
        return F.coalesce(known, F.lit(0)) if column == "prior_total_arr_usd" else known

    bars = _bars(portfolio, amount_of)
    # Eight rows of one month.
    upto = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    total_row = F.col("position") == len(BRIDGE)
    running = F.sum("amount").over(upto)
    running_before = F.coalesce(F.sum("amount").over(before), F.lit(0))
    return bars.select(
        F.col("position").alias("sort_order"), F.col("label").alias("category"),
        F.when(total_row, F.lit(0)).otherwise(F.least(running_before, running))
        .alias("base_invisible"),
        F.when(total_row, F.col("amount")).otherwise(F.abs("amount")).alias("bar_visible"),
        F.col("amount").alias("raw_delta"))


def bridge_running_total(portfolio: DataFrame) -> DataFrame:
    """Bridge table with numbered labels and the running total per step.

    From the FX step on, the running total is the reported month total.
    """
    bars = _bars(portfolio, F.col)
    upto = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy("position").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    parts_known = F.count("amount").over(upto) == F.col("position")
    return bars.select(
        "position",
        F.concat(F.col("position").cast("string"), F.lit(". "), "label").alias("component"),
        F.col("amount").alias("amount_usd"),
        F.when(F.col("position") >= len(BRIDGE) - 1, F.last("amount").over(whole))
        .otherwise(F.when(parts_known, F.sum("amount").over(upto))).alias("running_total"))


def movement_components(bridge_table: DataFrame) -> DataFrame:
    """The bridge without its starting and ending anchors."""
    anchors = [f"{i}. {label}" for i, (label, _) in enumerate(BRIDGE, start=1)
               if label in ("Starting ARR", "Ending ARR")]
    return bridge_table.where(~F.col("component").isin(*anchors))


def arr_trend_by_movement(portfolio: DataFrame) -> DataFrame:
    """Month by movement type, long form."""
    cells = [F.struct(F.lit(label).alias("movement_type"), F.col(column).alias("amount_usd"))
             for label, column in TREND]
    return portfolio.select("month_end_date", F.inline(F.array(*cells)))


def arr_trend_wide(portfolio: DataFrame) -> DataFrame:
    """Month by movement type, one column per type."""
    return portfolio.select("month_end_date", *[F.col(c).alias(label) for label, c in TREND])


def _arr_by(account_waterfall: DataFrame, dimension: str, month: date | None) -> DataFrame:
    return (latest(account_waterfall, "month_end_date", month).groupBy(dimension)
            .agg(F.sum("account_arr_usd").alias("arr_usd")).orderBy(F.desc("arr_usd")))


def arr_by_segment(account_waterfall: DataFrame, month: date | None = None) -> DataFrame:
    """The newest month's total by segment; ``month`` names it where it is known."""
    return _arr_by(account_waterfall, "segment", month)


def arr_by_region(account_waterfall: DataFrame, month: date | None = None) -> DataFrame:
    """The newest month's total by region; ``month`` names it where it is known."""
    return _arr_by(account_waterfall, "region", month)


def kpi_cards(portfolio: DataFrame) -> DataFrame:
    """Total, growth and loss of the latest month."""
    newest = portfolio.orderBy(F.desc("month_end_date")).limit(1)
    return newest.select(
        "month_end_date", "total_arr_usd",
        percent_change("total_arr_usd", "prior_total_arr_usd").alias("mom_change_pct"),
        (F.col("new_arr_usd") + F.col("expansion_arr_usd")).alias("new_plus_expansion_usd"),
        (F.col("contraction_arr_usd") + F.col("churn_arr_usd"))
        .alias("contraction_plus_churn_usd"))
