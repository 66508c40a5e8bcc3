"""Validity intervals over version logs (the source already keeps every version)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.ordered import with_next
from tallyspark.functions.scalar import open_ended


def contract_validity(contracts: DataFrame) -> DataFrame:
    """Half-open validity ``[effective_start_date, effective_end_date_exclusive)`` per version.

    A version ends where the next one starts, else at its own end, else never. ``is_last_version``
    marks the end of the log of a contract.
    """
    followed = with_next(contracts, ["contract_id"], "version_number", "effective_start_date",
                         into="_next_start", is_last="is_last_version")
    return followed.select(
        "contract_version_sk", "contract_id", "version_number", "account_id",
        "effective_start_date",
        open_ended("_next_start", "effective_end_date").alias("effective_end_date_exclusive"),
        "arr_amount", "currency", "seats", "plan_tier", "amendment_type",
        "contract_version_recorded_at", "is_backdated", "co_termination_group",
        (F.col("amendment_type") == "churn").alias("is_churn_version"), "is_last_version")


def with_account_place(validity: DataFrame, accounts: DataFrame) -> DataFrame:
    """Adds the region and entity of the account to validity rows."""
    places = accounts.select("account_id", "region", "legal_entity")
    return validity.join(places, "account_id", "left").select(
        "contract_version_sk", "contract_id", "version_number", "account_id", "region",
        "legal_entity", *validity.columns[4:])


def contract_versions(contracts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Contract versions with validity and the region and entity of their account."""
    return with_account_place(contract_validity(contracts), accounts)


def customer_master_versions(customer_master: DataFrame) -> DataFrame:
    """Customer master versions with validity and a flag on the current one."""
    followed = with_next(customer_master, ["account_id"], "customer_master_version", "updated_at",
                         into="_next_update", is_last="is_current_version")
    return followed.select(
        "customer_master_sk", "account_id", "customer_master_version", "billing_contact_name",
        "billing_contact_email", "tax_id", "address_line1", "city", "region", "legal_entity",
        "updated_at", open_ended("_next_update").alias("effective_end_date_exclusive"),
        "is_current_version")


def dim_customer(versions: DataFrame) -> DataFrame:
    """Current customer master, one row per account, not yet governed."""
    return versions.where("is_current_version").select(
        "account_id", "billing_contact_name", "billing_contact_email", "tax_id", "address_line1",
        "city", "region", "legal_entity",
        F.col("updated_at").alias("customer_master_updated_at"))
