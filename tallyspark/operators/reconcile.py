"""Billed, recognized, collected and credited amounts by month and legal entity, in USD."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.functions.scalar import (
    as_of_date, as_of_timestamp, days_before, guarded_divide, month_start,
)
from tallyspark.operators.fx import rate_on, to_usd
from tallyspark.operators.staging import PAYMENT_IDENTITY, dedupe_payments
from tallyspark.session import stage_table
from tallyspark.sources.facts import FACT_DATE, MONTH, own_lines
from tallyspark.sources.tables import empty_like, replace_keys, within_range

KEY = ("month_start", "legal_entity")
MEASURES = ("billed_usd", "recognized_usd", "credit_usd", "collected_usd", "manual_adjustment_usd")


@dataclass(frozen=True)
class Facts:
    """Inputs of the reconciliation: staged tables, with payments as landed, copies included.

    Where the ledger carries ``account_id`` (``sources.facts``), the invoices are not needed to
    find it. Where the tables carry their month as a partition, only the folders of the months
    asked for are read.
    """

    invoices: DataFrame
    credit_memos: DataFrame
    landed_payments: DataFrame
    gl_journal_entries: DataFrame
    accounts: DataFrame
    #: Where ledger lines find their invoice, if not among ``invoices``.
    owners: DataFrame | None = None

    @property
    def payments(self) -> DataFrame:
        return dedupe_payments(self.landed_payments)

    @property
    def ledger(self) -> DataFrame:
        """Journal lines with the account of their invoice."""
        lines = self.gl_journal_entries
        return lines if "account_id" in lines.columns else own_lines(lines, self.owning_invoices)

    @property
    def owning_invoices(self) -> DataFrame:
        return self.invoices if self.owners is None else self.owners

    def payments_since(self, since: Column) -> DataFrame:
        """Payments that survive deduplication and arrived at or after a moment.

        Only payments with a recent copy can qualify, so the rest is left out before deduplicating.
        Copies share their date: the months or dates of the recent ones are found first and reach
        the scan. The identity may hold NULLs, which count as equal here.
        """
        recent = F.col(S.LOADED_AT) >= since
        arrived = self.landed_payments.where(recent)
        if MONTH in self.landed_payments.columns:
            near = in_months(self.landed_payments, "payment_date", distinct_months(arrived, MONTH))
        else:
            near = within_range(self.landed_payments, arrived, ["payment_date"])
        touched = arrived.select(*[F.col(c).alias(f"_{c}") for c in PAYMENT_IDENTITY]).distinct()
        same = reduce(lambda a, b: a & b, [
            F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PAYMENT_IDENTITY])
        return dedupe_payments(
            near.join(touched, same, "left_semi")).where(recent)

    def only_months(self, months: Sequence[date | None]) -> Facts:
        """The facts dated in the given months. They are few: the calendar bounds them."""
        return Facts(
            in_months(self.invoices, FACT_DATE["invoices"], months),
            in_months(self.credit_memos, FACT_DATE["credit_memos"], months),
            in_months(self.landed_payments, FACT_DATE["payments"], months),
            in_months(self.gl_journal_entries, FACT_DATE["gl_journal_entries"], months),
            self.accounts, self.owning_invoices)


def distinct_months(df: DataFrame, month: str) -> list[date | None]:
    """The months that occur, fetched: at most one value for each month of the calendar."""
    return [r[0] for r in df.select(month).distinct().collect()]


def in_months(df: DataFrame, day: str, months: Sequence[date | None]) -> DataFrame:
    """Rows dated in one of the months, given as literals.

    On a table laid out by month the condition names its folders. The range of the months is a plain
    comparison of the date column besides, which prunes files by their statistics.
    """
    known = sorted(m for m in months if m is not None)
    wanted = F.col(MONTH) if MONTH in df.columns else month_start(day)
    near = F.lit(True)
    if known:
        near = (F.col(day) >= F.lit(known[0])) & (F.col(day) < F.add_months(F.lit(known[-1]), 1))
    hit = near & wanted.isin(known) if known else F.lit(False)
    return df.where(hit | wanted.isNull() if None in months else hit)


def _monthly(df: DataFrame, owner: str, day: str, **measures: Column) -> DataFrame:
    """Sums per owner and month. Combines on the map side, so a busy owner stays small."""
    month = month_start(day).alias("month_start")
    if not measures:
        return df.select(owner, month).distinct()
    return df.groupBy(owner, month).agg(*[F.sum(c).alias(name) for name, c in measures.items()])


def _with_entity(df: DataFrame, accounts: DataFrame) -> DataFrame:
    return df.join(accounts.select("account_id", "legal_entity"), "account_id", "left")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def revenue_lines(gl: DataFrame, fx: DataFrame) -> DataFrame:
    """Journal lines with their signed effect on revenue in USD, and the manual part of it.

    Lines of other accounts count as zero whatever their rate, and are not converted.
    """
    side = F.col("debit_credit")
    counts = (F.col("gl_account") == S.REVENUE_ACCOUNT) & side.isin(S.CREDIT, S.DEBIT)
    signed = F.when(side == S.CREDIT, F.col("amount")).otherwise(-F.col("amount"))
    manual = F.col("je_type") == S.JE_TYPES[2]
    zero = F.lit(0)
    return (
        rate_on(gl, fx, "posting_date", "currency", "_rate")
        .withColumn("_signed_usd", F.when(counts, guarded_divide(signed, "_rate")).otherwise(zero))
        .withColumn("_manual_usd", F.when(manual, F.col("_signed_usd")).otherwise(zero))
    )


def revenue_reconciliation(facts: Facts, fx: DataFrame) -> DataFrame:
    """All measures per month and entity.

    Amounts are converted next to the scan, summed per account and month, and only then joined to
    the accounts; ledger lines without an account are summed per invoice before they meet theirs.
    The measures of all facts travel as columns of one union through one
    aggregation. Keys without an entity are listed with zero measures.
    """
    usd = F.col("amount_usd")
    effects = {"recognized_usd": F.col("_signed_usd"),
               "manual_adjustment_usd": F.col("_manual_usd")}
    lines = revenue_lines(facts.gl_journal_entries, fx)
    if "account_id" in lines.columns:
        ledger = _monthly(lines, "account_id", "posting_date", **effects)
    else:
        by_invoice = _monthly(lines, "invoice_id", "posting_date", **effects)
        ledger = own_lines(by_invoice, facts.owning_invoices).drop("invoice_id")
    per_account = _union([
        _monthly(to_usd(facts.invoices, fx, "invoice_date"), "account_id", "invoice_date",
                 billed_usd=usd),
        _monthly(to_usd(facts.credit_memos, fx, "issue_date"), "account_id", "issue_date",
                 credit_usd=usd),
        _monthly(to_usd(facts.payments, fx, "payment_date"), "account_id", "payment_date",
                 collected_usd=usd),
        ledger,
    ])
    totals = _with_entity(per_account, facts.accounts).groupBy(*KEY).agg(
        *[F.sum(m).alias(m) for m in MEASURES])
    known_key = F.col("month_start").isNotNull() & F.col("legal_entity").isNotNull()
    zero = F.lit(0)
    measured = totals.select(
        *KEY, *[F.coalesce(F.when(known_key, F.col(m)), zero).alias(m) for m in MEASURES])
    return measured.withColumn(
        "recognized_net_of_credits_usd",
        F.round(F.col("recognized_usd") - F.col("credit_usd"), 2))


#: Rows of the facts that a step takes, as long as MOST_STEPS are enough.
STEP_ROWS = 5_000_000
MOST_STEPS = 6


def _steps(facts: Facts) -> list[list[date | None]]:
    """The months of the facts in runs of about as many rows. Rows are counted by month, and the
    counts fetched: at most one for each month of the calendar and table."""
    rows: Counter[date | None] = Counter()
    for df in (facts.invoices, facts.credit_memos, facts.landed_payments,
               facts.gl_journal_entries):
        rows.update({month: n for month, n in df.groupBy(MONTH).count().collect()})
    size = max(STEP_ROWS, -(-rows.total() // MOST_STEPS))
    steps: dict[int, list[date | None]] = {}
    before = 0
    for month in sorted(rows, key=lambda m: (m is not None, m)):
        steps.setdefault(before // size, []).append(month)
        before += rows[month]
    return list(steps.values())


def revenue_reconciliation_in_steps(facts: Facts, fx: DataFrame,
                                    stage: Callable[..., DataFrame] = stage_table) -> DataFrame:
    """``revenue_reconciliation`` of facts laid out by month, some months after the other.

    Every fact counts in the month it is dated in, copies of a payment share their date, so no
    month needs another. The totals of a step are staged, and its shuffles are gone before the
    next begins. Facts without a layout are taken at once.
    """
    laid = all(MONTH in df.columns for df in (
        facts.invoices, facts.credit_memos, facts.landed_payments, facts.gl_journal_entries))
    steps = _steps(facts) if laid else []
    if len(steps) < 2:
        return revenue_reconciliation(facts, fx)
    return reduce(DataFrame.unionByName, [
        stage(revenue_reconciliation(facts.only_months(months), fx), "reconciliation")
        for months in steps])


def affected_keys(facts: Facts, as_of: date | str | None = None,
                  lookback_days: int = S.LOOKBACK_DAYS) -> DataFrame:
    """Keys with a row that arrived within the lookback before ``as_of``.

    There is no upper bound: a run for a past date also takes what was loaded since. Credit memos
    arrive by their system entry date and belong to the month they were issued for.
    """
    since = days_before(as_of_timestamp(as_of), lookback_days)
    since_day = F.date_sub(as_of_date(as_of), lookback_days)
    recent = F.col(S.LOADED_AT) >= since
    touched = _union([
        _monthly(facts.invoices.where(recent), "account_id", "invoice_date"),
        _monthly(facts.credit_memos.where(F.col("system_entry_date") >= since_day),
                 "account_id", "issue_date"),
        _monthly(facts.payments_since(since), "account_id", "payment_date"),
        _monthly(facts.ledger.where(recent), "account_id", "posting_date"),
    ])
    return _with_entity(touched, facts.accounts).select(*KEY).distinct()


def revenue_reconciliation_for(keys: DataFrame, facts: Facts, fx: DataFrame) -> DataFrame:
    """Full totals of the given keys only, reading only facts of their months.

    Keys are matched by equality, so a key without an entity is not reprocessed. The keys are read
    several times, the first time here to find the range of months: pass them from a table.
    """
    months = distinct_months(keys.where("legal_entity is not null"), "month_start")
    if not months:
        return empty_like(keys.sparkSession, revenue_reconciliation(facts, fx).schema)
    return revenue_reconciliation(facts.only_months(months), fx).join(
        keys, list(KEY), "left_semi")


def revenue_reconciliation_incremental(current: DataFrame, facts: Facts, fx: DataFrame,
                                       as_of: date | str | None = None,
                                       lookback_days: int = S.LOOKBACK_DAYS,
                                       keys: DataFrame | None = None) -> DataFrame:
    """``current`` with every touched key replaced by its recomputed totals.

    ``keys`` takes the touched keys from a table, where they were written before.
    """
    if keys is None:
        keys = affected_keys(facts, as_of, lookback_days)
    return replace_keys(current, revenue_reconciliation_for(keys, facts, fx), KEY)
