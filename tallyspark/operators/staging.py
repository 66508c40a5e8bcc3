"""Source-conformed views of the landed tables: projection, renames, keys, payment dedupe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.functions.scalar import surrogate_key

# What makes two landed payments copies of one.
PAYMENT_IDENTITY = ("invoice_id", "payment_date", "amount", "currency")


def _landed_columns(table: str) -> list[str]:
    return [*S.LANDED[table].fieldNames(), S.LOADED_AT]


def stg_accounts(accounts: DataFrame) -> DataFrame:
    return (accounts.select(*_landed_columns("accounts"))
            .withColumnRenamed("created_date", "account_created_date"))


def stg_contracts(contracts: DataFrame) -> DataFrame:
    key = surrogate_key("contract_id", "version_number").alias("contract_version_sk")
    return (contracts.select(key, *_landed_columns("contracts"))
            .withColumnRenamed("created_at", "contract_version_recorded_at"))


def stg_customer_master(customer_master: DataFrame) -> DataFrame:
    key = surrogate_key("account_id", "version").alias("customer_master_sk")
    return (customer_master.select(key, *_landed_columns("customer_master"))
            .withColumnRenamed("version", "customer_master_version"))


def stg_fx_rates(fx_rates: DataFrame) -> DataFrame:
    return fx_rates.select(*_landed_columns("fx_rates"))


def stg_invoices(invoices: DataFrame) -> DataFrame:
    return invoices.select(*_landed_columns("invoices"))


def stg_invoice_line_items(invoice_line_items: DataFrame) -> DataFrame:
    return invoice_line_items.select(*_landed_columns("invoice_line_items"))


def stg_credit_memos(credit_memos: DataFrame) -> DataFrame:
    """Every memo as landed: late ones are the signal restatement depends on."""
    return credit_memos.select(*_landed_columns("credit_memos"))


def dedupe_payments(payments: DataFrame) -> DataFrame:
    """One row per (invoice, date, amount, currency): the one with the lowest payment id.

    An aggregate instead of a ranking window: copies collapse on the map side, so a payment
    repeated any number of times sends one row per map task to its reducer.
    """
    rest = [c for c in payments.columns if c not in PAYMENT_IDENTITY]
    # The row itself is what is compared, so it travels once.
    survivor = F.min(F.struct(F.col("payment_id").isNull().alias("_unknown"),
                              *["payment_id", *[c for c in rest if c != "payment_id"]]))
    return (payments.groupBy(*PAYMENT_IDENTITY).agg(survivor.alias("_row"))
            .select(*[F.col(c) if c in PAYMENT_IDENTITY else F.col(f"_row.{c}")
                      for c in payments.columns]))


def stg_payments(payments: DataFrame) -> DataFrame:
    return dedupe_payments(payments.select(*_landed_columns("payments")))


def stg_gl_journal_entries(gl_journal_entries: DataFrame) -> DataFrame:
    return (gl_journal_entries.select(*_landed_columns("gl_journal_entries"))
            .withColumnRenamed("reference_id", "invoice_id"))
