"""Masks and row filters by role, and the views governed by them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.functions.masking import Mask, mask_email, mask_pii_text, mask_tax_id

BROADCAST_ENTITIES = 100_000

CUSTOMER_MASKS: dict[str, Mask] = {
    "billing_contact_name": mask_pii_text,
    "billing_contact_email": mask_email,
    "tax_id": mask_tax_id,
    "address_line1": mask_pii_text,
}


def analyst_entity_access(spark: SparkSession, rows: Sequence[tuple] = ()) -> DataFrame:
    """The mapping of analysts to the entities they may see."""
    return spark.createDataFrame(list(rows), S.SIDE_INPUTS["analyst_entity_access"])


def apply_masks(df: DataFrame, masks: Mapping[str, Mask], role: str) -> DataFrame:
    return df.withColumns({column: mask(column, role) for column, mask in masks.items()})


def row_access(df: DataFrame, mapping: DataFrame, role: str, user: str,
               all_entity_roles: Sequence[str] = S.ALL_ENTITY_ROLES) -> DataFrame:
    """All rows for roles that see every entity, else the rows of the user's own entities.

    Entities are few and hold many rows each, so shuffling by entity would be uneven. The user's
    entities are counted first (a small job on the mapping) and broadcast when within the limit;
    a longer list is joined as Spark sees fit.
    """
    if role in all_entity_roles:
        return df
    mine = mapping.where(F.col("user_name") == user).select("legal_entity").distinct()
    if mine.limit(BROADCAST_ENTITIES + 1).count() <= BROADCAST_ENTITIES:
        mine = F.broadcast(mine)
    return df.join(mine, "legal_entity", "left_semi").select(*df.columns)


def governed_dim_customer(dim_customer: DataFrame, mapping: DataFrame, role: str,
                          user: str) -> DataFrame:
    return apply_masks(row_access(dim_customer, mapping, role, user), CUSTOMER_MASKS, role)


def governed_views(marts: Mapping[str, DataFrame], mapping: DataFrame, role: str,
                   user: str) -> dict[str, DataFrame]:
    """The marts as this role and user see them, also registered as temporary views.

    Customer dimension, account waterfall and reconciliation are limited by entity. The portfolio
    waterfall is a company-wide figure and is shown to everyone.
    """
    views = dict(marts)
    for name in ("fct_arr_waterfall_account_monthly", "fct_revenue_reconciliation_monthly"):
        if name in marts:
            views[name] = row_access(marts[name], mapping, role, user)
    if "dim_customer" in marts:
        views["dim_customer"] = governed_dim_customer(marts["dim_customer"], mapping, role, user)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
