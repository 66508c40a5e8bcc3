"""Billing and ledger derivations: invoice schedule, lines, journal postings, co-termination."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.operators.staging import dedupe_payments


def billing_schedule(versions: DataFrame, window_end: date | str) -> DataFrame:
    """One invoice every 30 days over the active period of each version.

    A version is billed from its start up to (not including) the end of its validity, cut at
    ``window_end``. Versions without recurring amount are not billed.
    """
    stop = F.least(F.col("effective_end_date_exclusive"), F.lit(str(window_end)).cast("date"))
    every = F.make_dt_interval(F.lit(S.BILLING_PERIOD_DAYS))
    due = F.when(F.col("effective_start_date") < stop,
                 F.sequence("effective_start_date", F.date_sub(stop, 1), every))
    return (
        versions.where("arr_amount > 0")
        .select("contract_id", "version_number", "account_id", "currency", "seats", "plan_tier",
                F.round(F.col("arr_amount") / 12, 2).cast(S.MONEY).alias("amount"),
                F.posexplode(due).alias("_period", "invoice_date"))
        .select(
            F.concat_ws("-", F.lit("INV"), "contract_id", F.col("version_number").cast("string"),
                        (F.col("_period") + 1).cast("string")).alias("invoice_id"),
            "contract_id", "account_id", "invoice_date", "currency", "amount", "seats",
            "plan_tier")
    )


def invoice_lines(schedule: DataFrame) -> DataFrame:
    """The single line of each scheduled invoice."""
    seats = F.greatest(F.col("seats"), F.lit(1))
    return schedule.select(
        F.concat("invoice_id", F.lit("-L1")).alias("invoice_line_id"), "invoice_id",
        F.concat("plan_tier", F.lit(" plan - "), F.col("seats").cast("string"), F.lit(" seats"))
        .alias("description"),
        F.col("seats").alias("quantity"),
        F.round(F.col("amount") / seats, 4).cast(S.UNIT_PRICE).alias("unit_amount"),
        "amount")


def _leg(number: int, account: str, side: Column | str) -> Column:
    side = F.lit(side) if isinstance(side, str) else side
    return F.struct(F.lit(str(number)).alias("n"), F.lit(account).alias("gl_account"),
                    side.alias("debit_credit"))


def _post(events: DataFrame, event_id: str, day: str, amount: Column, je_type: str,
          *legs: Column) -> DataFrame:
    """Every event becomes its journal lines, with ids derived from the event id."""
    return events.select(
        F.col(event_id).alias("_event"), F.col(day).alias("posting_date"), amount.alias("amount"),
        "currency", F.col("invoice_id").alias("reference_id"), F.inline(F.array(*legs)),
    ).select(
        F.concat_ws("-", F.lit("JE"), "_event", "n").alias("je_id"), "posting_date", "gl_account",
        "debit_credit", "amount", "currency", "reference_id", F.lit(je_type).alias("je_type"))


def gl_postings(invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Double entry for invoices and for payments, a duplicated payment posting once."""
    billed = _post(invoices, "invoice_id", "invoice_date", F.col("amount"), S.JE_TYPES[0],
                   _leg(1, S.REVENUE_ACCOUNT, S.CREDIT), _leg(2, S.RECEIVABLE_ACCOUNT, S.DEBIT))
    paid = _post(dedupe_payments(payments), "payment_id", "payment_date", F.col("amount"),
                 S.JE_TYPES[1],
                 _leg(1, S.CASH_ACCOUNT, S.DEBIT), _leg(2, S.RECEIVABLE_ACCOUNT, S.CREDIT))
    return billed.unionByName(paid)


def post_manual_adjustments(adjustments: DataFrame, date_column: str = "posting_date") -> DataFrame:
    """Balanced pair for each signed ``adjustment`` of an invoice; zero posts nothing."""
    up = F.col("adjustment") > 0
    events = adjustments.where("adjustment <> 0").withColumn(
        "_id", F.concat(F.lit("ADJ-"), "invoice_id"))
    return _post(
        events, "_id", date_column, F.abs("adjustment").cast(S.MONEY), S.JE_TYPES[2],
        _leg(1, S.ADJUSTMENT_ACCOUNT, F.when(up, S.DEBIT).otherwise(S.CREDIT)),
        _leg(2, S.REVENUE_ACCOUNT, F.when(up, S.CREDIT).otherwise(S.DEBIT)))


def gl_imbalance(gl: DataFrame) -> DataFrame:
    """References and entry types whose debits and credits differ; empty for a balanced ledger."""
    signed = F.when(F.col("debit_credit") == S.DEBIT, F.col("amount")).otherwise(-F.col("amount"))
    return (gl.groupBy("reference_id", "je_type").agg(F.sum(signed).alias("imbalance"))
            .where("imbalance <> 0"))


def gl_is_balanced(gl: DataFrame) -> bool:
    return gl_imbalance(gl).isEmpty()


def co_termination_group(contracts: DataFrame) -> DataFrame:
    """Contracts with the account id as group where the account has several, else NULL.

    Two extremes per account tell one contract from several without gathering the ids.
    """
    shared = (
        contracts.groupBy("account_id")
        .agg(F.min("contract_id").alias("_lo"), F.max("contract_id").alias("_hi"))
        .where("_lo <> _hi").select("account_id", F.col("account_id").alias("_group")))
    return (contracts.drop("co_termination_group").join(shared, "account_id", "left")
            .withColumnRenamed("_group", "co_termination_group"))
