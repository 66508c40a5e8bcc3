"""The declared checks of every landed table and model, and one report over all of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.operators import quality
from tallyspark.session import stage_table


@dataclass(frozen=True)
class Checks:
    """What must hold for one table."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    parents: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    combination: tuple[str, ...] = ()

    def __len__(self) -> int:
        return (len(self.not_null) + len(self.unique) + len(self.accepted) + len(self.parents)
                + bool(self.combination))


# ---- Fixed values: the declared checks ------------------------------------------------------
SOURCE_CHECKS: dict[str, Checks] = {
    "accounts": Checks(
        not_null=("account_id", "account_name", "legal_entity", "created_date"),
        unique=("account_id",),
        accepted={"region": S.REGIONS, "currency": S.CURRENCIES, "segment": S.SEGMENTS}),
    "contracts": Checks(
        not_null=("contract_id", "version_number", "account_id", "effective_start_date",
                  "arr_amount", "created_at"),
        accepted={"currency": S.CURRENCIES, "amendment_type": S.AMENDMENT_TYPES}),
    "customer_master": Checks(
        not_null=("account_id", "version", "updated_at"), accepted={"region": S.REGIONS}),
    "fx_rates": Checks(
        not_null=("rate_date", "quote_currency", "fx_rate"),
        accepted={"base_currency": (S.BASE_CURRENCY,), "quote_currency": S.CURRENCIES}),
    "invoices": Checks(
        not_null=("invoice_id", "contract_id", "account_id", "invoice_date", "amount"),
        unique=("invoice_id",), accepted={"currency": S.CURRENCIES}),
    "invoice_line_items": Checks(
        not_null=("invoice_line_id", "invoice_id", "amount"), unique=("invoice_line_id",)),
    "credit_memos": Checks(
        not_null=("credit_memo_id", "invoice_id", "account_id", "issue_date",
                  "system_entry_date", "amount"),
        unique=("credit_memo_id",),
        accepted={"currency": S.CURRENCIES, "reason": S.CREDIT_REASONS}),
    "payments": Checks(
        not_null=("payment_id", "invoice_id", "account_id", "payment_date", "amount"),
        unique=("payment_id",), accepted={"currency": S.CURRENCIES}),
    "gl_journal_entries": Checks(
        not_null=("je_id", "posting_date", "gl_account", "amount"), unique=("je_id",),
        accepted={"debit_credit": (S.DEBIT, S.CREDIT), "currency": S.CURRENCIES,
                  "je_type": S.JE_TYPES}),
}

MODEL_CHECKS: dict[str, Checks] = {
    "stg_accounts": Checks(
        not_null=("account_id",), unique=("account_id",),
        accepted={"region": S.REGIONS, "currency": S.CURRENCIES}),
    "stg_contracts": Checks(
        not_null=("contract_version_sk", "contract_id", "account_id", "arr_amount"),
        unique=("contract_version_sk",), accepted={"amendment_type": S.AMENDMENT_TYPES},
        parents={"account_id": ("stg_accounts", "account_id")}),
    "stg_customer_master": Checks(
        not_null=("customer_master_sk", "account_id", "customer_master_version"),
        unique=("customer_master_sk",),
        parents={"account_id": ("stg_accounts", "account_id")}),
    "stg_fx_rates": Checks(
        not_null=("quote_currency", "fx_rate"), accepted={"quote_currency": S.CURRENCIES},
        combination=("rate_date", "quote_currency")),
    "stg_invoices": Checks(
        not_null=("invoice_id", "contract_id", "account_id", "amount"), unique=("invoice_id",),
        parents={"contract_id": ("stg_contracts", "contract_id"),
                 "account_id": ("stg_accounts", "account_id")}),
    "stg_invoice_line_items": Checks(
        not_null=("invoice_line_id", "invoice_id"), unique=("invoice_line_id",),
        parents={"invoice_id": ("stg_invoices", "invoice_id")}),
    "stg_credit_memos": Checks(
        not_null=("credit_memo_id", "invoice_id", "amount"), unique=("credit_memo_id",),
        parents={"invoice_id": ("stg_invoices", "invoice_id")}),
    "stg_payments": Checks(
        not_null=("payment_id", "invoice_id", "amount"), unique=("payment_id",),
        parents={"invoice_id": ("stg_invoices", "invoice_id")},
        combination=("invoice_id", "payment_date", "amount", "currency")),
    "stg_gl_journal_entries": Checks(
        not_null=("je_id",), unique=("je_id",),
        accepted={"debit_credit": (S.DEBIT, S.CREDIT), "je_type": S.JE_TYPES},
        parents={"invoice_id": ("stg_invoices", "invoice_id")}),
    "int_date_spine_daily": Checks(not_null=("date_day",), unique=("date_day",)),
    "int_date_spine_month_end": Checks(
        not_null=("month_end_date",), unique=("month_end_date",)),
    "int_fx_rates_daily_filled": Checks(
        not_null=("rate_date", "quote_currency", "fx_rate"),
        accepted={"quote_currency": S.CURRENCIES}, combination=("rate_date", "quote_currency")),
    "int_customer_master_versions": Checks(
        not_null=("customer_master_sk", "effective_end_date_exclusive"),
        unique=("customer_master_sk",),
        combination=("account_id", "customer_master_version")),
    "int_contract_versions": Checks(
        not_null=("contract_version_sk", "effective_end_date_exclusive"),
        unique=("contract_version_sk",)),
    "int_contract_arr_monthly": Checks(
        not_null=("arr_usd",), combination=("contract_id", "month_end_date")),
    "int_account_arr_monthly": Checks(
        not_null=("account_arr_usd",), combination=("account_id", "month_end_date")),
    "int_contract_arr_bridge_monthly": Checks(
        not_null=("real_component_usd", "fx_component_usd"),
        combination=("contract_id", "month_end_date")),
    "fct_arr_movements": Checks(
        not_null=("arr_movement_sk", "movement_type", "account_id"),
        unique=("arr_movement_sk",), accepted={"movement_type": S.MOVEMENT_TYPES},
        parents={"account_id": ("stg_accounts", "account_id")}),
    "fct_arr_waterfall_account_monthly": Checks(combination=("account_id", "month_end_date")),
    "fct_arr_waterfall_portfolio_monthly": Checks(
        not_null=("month_end_date", "total_arr_usd"), unique=("month_end_date",)),
    "fct_revenue_reconciliation_monthly": Checks(
        not_null=("month_start", "legal_entity", "recognized_net_of_credits_usd"),
        combination=("month_start", "legal_entity")),
    "dim_customer": Checks(
        not_null=("account_id", "billing_contact_email"), unique=("account_id",)),
    "rpt_restatement_log": Checks(not_null=("run_started_at", "month_start")),
}

FRESHNESS: dict[str, tuple[timedelta, timedelta]] = {
    "accounts": (timedelta(hours=30), timedelta(hours=48)),
    "contracts": (timedelta(hours=30), timedelta(hours=48)),
    "customer_master": (timedelta(hours=30), timedelta(hours=48)),
    "fx_rates": (timedelta(days=3), timedelta(days=5)),
    "invoices": (timedelta(hours=24), timedelta(hours=30)),
    "invoice_line_items": (timedelta(hours=24), timedelta(hours=30)),
    "credit_memos": (timedelta(hours=30), timedelta(hours=48)),
    "payments": (timedelta(hours=24), timedelta(hours=30)),
    "gl_journal_entries": (timedelta(days=35), timedelta(days=40)),
}
# ----------------------------------------------------------------------------------------------


def _key_sets(declared: Mapping[str, Checks], name: str) -> list[tuple[str, ...]]:
    """The columns whose values some check of this table, or of a child of it, has to know."""
    own = declared.get(name, Checks())
    wanted = [(c,) for c in (*own.unique, *own.parents)]
    wanted += [own.combination] if own.combination else []
    wanted += [(key,) for checks in declared.values() for parent, key in checks.parents.values()
               if parent == name]
    return sorted(set(wanted))


_ROWS = -1


def _failing(checks: Checks) -> list[tuple[str, str, Column]]:
    """The checks that a row fails on its own."""
    return [("not_null", c, F.col(c).isNull()) for c in checks.not_null] + [
        ("accepted_values", c, F.coalesce(~F.col(c).isin(*values), F.lit(False)))
        for c, values in checks.accepted.items()]


def key_profile(df: DataFrame, checks: Checks, key_sets: Sequence[tuple[str, ...]]) -> DataFrame:
    """How often each value of each key set occurs, and how many rows fail the same row checks.

    One pass over ``df`` and one count, combined on the map side, serve every check. Values keep
    their types until they are counted. A row that fails checks counts under the key set
    ``_ROWS - m``, where ``m`` has a bit for each of them.
    """
    failing = reduce(lambda a, b: a + b, [
        F.when(bad, F.lit(1 << k)).otherwise(F.lit(0))
        for k, (_, _, bad) in enumerate(_failing(checks))], F.lit(0))
    columns = list(dict.fromkeys(c for own in key_sets for c in own))

    def cell(key_set: Column, own: Sequence[str]) -> Column:
        return F.struct(key_set.alias("key_set"), *[
            (F.col(f"key_{i}") if c in own else F.lit(None).cast(df.schema[c].dataType))
            .alias(f"key_{i}") for i, c in enumerate(columns)])

    cells = [cell(F.lit(i), own) for i, own in enumerate(key_sets)]
    bad_row = F.array(*cells, cell(F.lit(_ROWS) - F.col("_failing"), ()))
    cells = F.array(*cells) if cells else F.slice(bad_row, 1, 0)
    counted = (
        df.select(failing.alias("_failing"),
                  *[F.col(c).alias(f"key_{i}") for i, c in enumerate(columns)])
        .select(F.inline(F.when(F.col("_failing") > 0, bad_row).otherwise(cells)))
        .groupBy("key_set", *[f"key_{i}" for i in range(len(columns))])
        .agg(F.count("*").alias("n")))
    key = F.lit(None).cast("array<string>")
    for i, own in enumerate(key_sets):
        key = F.when(F.col("key_set") == i, F.array(*[
            F.col(f"key_{columns.index(c)}").cast("string") for c in own])).otherwise(key)
    return counted.select("key_set", key.alias("key"), "n")


def _asked_for(profile: DataFrame, name: str, sets: Sequence[tuple[str, ...]],
               declared: Mapping[str, Checks]) -> DataFrame:
    """The rows that a check asks for: those of failed row checks, all values of the key sets that
    are looked up in a parent or by a child, and of the others those that come more than once. One
    row without a failed check stands for all others."""
    own = declared.get(name, Checks())
    looked_up = {*own.parents, *[key for checks in declared.values()
                                 for parent, key in checks.parents.values() if parent == name]}
    whole = [i for i, columns in enumerate(sets) if len(columns) == 1 and columns[0] in looked_up]
    asked = (F.col("key_set") < 0) | F.col("key_set").isin(whole) | (F.col("n") > 1)
    others = profile.sparkSession.range(1).select(
        F.lit(_ROWS).alias("key_set"), F.lit(None).cast("array<string>").alias("key"),
        F.lit(0).cast("long").alias("n"))
    return profile.where(asked).unionAll(others)


def _counted(name: str, check: str, column: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count("*").alias("violations")).select(
        F.lit(name).alias("table_name"), F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"), "violations")


def check_report(tables: Mapping[str, DataFrame], declared: Mapping[str, Checks],
                 stage: Callable[..., DataFrame] = stage_table) -> DataFrame:
    """One row per declared check of the given tables, with its number of violations.

    Row checks count rows; the others count offending values or keys. Every table is read once, for
    its ``key_profile``; the checks, those of children that look for their parent included, read
    the profiles.
    """
    sets = {name: _key_sets(declared, name) for name in tables}
    profiles = {name: stage(_asked_for(
        key_profile(df, declared.get(name, Checks()), sets[name]), name, sets[name], declared),
        "profile") for name, df in tables.items() if sets[name] or name in declared}

    def keys(name: str, *columns: str) -> DataFrame:
        return profiles[name].where(F.col("key_set") == sets[name].index(columns))

    known = F.get("key", F.lit(0)).isNotNull()
    parts = []
    for name in tables:
        checks = declared.get(name, Checks())
        failing = _failing(checks)
        if failing:
            failed = F.lit(_ROWS) - F.col("key_set")
            totals = profiles[name].where(F.col("key_set") <= _ROWS).agg(
                *[F.coalesce(F.sum(F.when(failed.bitwiseAND(1 << k) != 0, F.col("n"))), F.lit(0))
                  .alias(f"bad_{k}") for k in range(len(failing))])
            cells = [F.struct(F.lit(check).alias("check_name"), F.lit(column).alias("column_name"),
                              F.col(f"bad_{k}").alias("violations"))
                     for k, (check, column, _) in enumerate(failing)]
            parts.append(totals.select(F.lit(name).alias("table_name"), F.inline(F.array(*cells))))
        parts += [_counted(name, "unique", c, keys(name, c).where(known & (F.col("n") > 1)))
                  for c in checks.unique]
        parts += [_counted(name, "relationships", c, keys(name, c).where(known).join(
            keys(parent, key).select("key"), "key", "left_anti"))
            for c, (parent, key) in checks.parents.items()]
        if checks.combination:
            parts.append(_counted(name, "unique_combination", ", ".join(checks.combination),
                                  keys(name, *checks.combination).where("n > 1")))
    return reduce(DataFrame.unionAll, parts)


def freshness_report(landed: Mapping[str, DataFrame], as_of: datetime | str | None = None,
                     limits: Mapping[str, tuple[timedelta, timedelta]] = FRESHNESS) -> DataFrame:
    """Newest load, age and status of every landed table."""
    parts = [
        quality.freshness(landed[name], S.LOADED_AT, warn, error, as_of)
        .select(F.lit(name).alias("table_name"), "*")
        for name, (warn, error) in limits.items() if name in landed]
    return reduce(DataFrame.unionAll, parts)
