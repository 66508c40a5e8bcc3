"""Landed-table schemas, keys, and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _LONG, _DATE, _BOOL = T.StringType(), T.LongType(), T.DateType(), T.BooleanType()
MONEY = T.DecimalType(18, 2)
UNIT_PRICE = T.DecimalType(18, 4)
RATE = T.DecimalType(18, 6)

LOADED_AT = "_loaded_at"


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


# ---- Fixed values: results depend on these exact texts -----------------------------------------
# Column names and types as landed, keys, and the texts of the data model.
LANDED: dict[str, T.StructType] = {
    "accounts": _schema(
        account_id=_STRING, account_name=_STRING, region=_STRING, legal_entity=_STRING,
        currency=_STRING, segment=_STRING, industry=_STRING, created_date=_DATE,
    ),
    "contracts": _schema(
        contract_id=_STRING, version_number=_LONG, account_id=_STRING,
        effective_start_date=_DATE, effective_end_date=_DATE, arr_amount=MONEY,
        currency=_STRING, seats=_LONG, plan_tier=_STRING, amendment_type=_STRING,
        created_at=_DATE, is_backdated=_BOOL, co_termination_group=_STRING,
    ),
    "customer_master": _schema(
        account_id=_STRING, version=_LONG, billing_contact_name=_STRING,
        billing_contact_email=_STRING, tax_id=_STRING, address_line1=_STRING, city=_STRING,
        region=_STRING, legal_entity=_STRING, updated_at=_DATE,
    ),
    "fx_rates": _schema(
        rate_date=_DATE, base_currency=_STRING, quote_currency=_STRING, fx_rate=RATE,
    ),
    "invoices": _schema(
        invoice_id=_STRING, contract_id=_STRING, account_id=_STRING, invoice_date=_DATE,
        currency=_STRING, amount=MONEY,
    ),
    "invoice_line_items": _schema(
        invoice_line_id=_STRING, invoice_id=_STRING, description=_STRING, quantity=_LONG,
        unit_amount=UNIT_PRICE, amount=MONEY,
    ),
    "credit_memos": _schema(
        credit_memo_id=_STRING, invoice_id=_STRING, account_id=_STRING, issue_date=_DATE,
        system_entry_date=_DATE, currency=_STRING, amount=MONEY, reason=_STRING,
    ),
    "payments": _schema(
        payment_id=_STRING, invoice_id=_STRING, account_id=_STRING, payment_date=_DATE,
        amount=MONEY, currency=_STRING,
    ),
    "gl_journal_entries": _schema(
        je_id=_STRING, posting_date=_DATE, gl_account=_STRING, debit_credit=_STRING,
        amount=MONEY, currency=_STRING, reference_id=_STRING, je_type=_STRING,
    ),
}

SIDE_INPUTS: dict[str, T.StructType] = {
    "analyst_entity_access": T.StructType([
        T.StructField("user_name", _STRING, False),
        T.StructField("legal_entity", _STRING, False),
        T.StructField("granted_at", T.TimestampNTZType(), True),
    ]),
    "query_history": _schema(
        query_id=_STRING, warehouse_name=_STRING, query_tag=_STRING,
        start_time=T.TimestampNTZType(), total_elapsed_time=_LONG,
    ),
    "warehouse_metering": _schema(
        warehouse_name=_STRING, start_time=T.TimestampNTZType(), credits_used=UNIT_PRICE,
    ),
}

NATURAL_KEYS: dict[str, tuple[str, ...]] = {
    "accounts": ("account_id",),
    "contracts": ("contract_id", "version_number"),
    "customer_master": ("account_id", "version"),
    "fx_rates": ("rate_date", "base_currency", "quote_currency"),
    "invoices": ("invoice_id",),
    "invoice_line_items": ("invoice_line_id",),
    "credit_memos": ("credit_memo_id",),
    "payments": ("payment_id",),
    "gl_journal_entries": ("je_id",),
}

# The column saying on which day a row reached its source system. Line items have none: they
# arrive with the invoices of the day.
LANDING_DATE: dict[str, str] = {
    "accounts": "created_date",
    "contracts": "created_at",
    "customer_master": "updated_at",
    "fx_rates": "rate_date",
    "invoices": "invoice_date",
    "credit_memos": "system_entry_date",
    "payments": "payment_date",
    "gl_journal_entries": "posting_date",
}

BILLING_FEED = ("invoices", "invoice_line_items", "credit_memos", "payments", "gl_journal_entries")


def with_loaded_at(schema: T.StructType) -> T.StructType:
    """The table schema a landing batch becomes once the load time is stamped on it."""
    return T.StructType([*schema.fields, T.StructField(LOADED_AT, T.TimestampNTZType(), True)])


BASE_CURRENCY = "USD"
CURRENCIES = ("USD", "EUR", "INR")
REGIONS = ("US", "EU", "IN")
SEGMENTS = ("SMB", "Mid-Market", "Enterprise")
LEGAL_ENTITY = {
    "US": "Northfall Ledgers Inc.",
    "EU": "Northfall Ledgers Europe B.V.",
    "IN": "Northfall Ledgers India Pvt. Ltd.",
}
AMENDMENT_TYPES = ("new", "upsell", "downgrade", "renewal", "currency_change", "churn")
MOVEMENT_TYPES = ("new", "expansion", "contraction", "churn", "reactivation", "no_change")
CREDIT_REASONS = ("service_credit", "billing_error", "goodwill", "downgrade_proration")
PLAN_TIERS = ("Starter", "Growth", "Enterprise")
CASH_ACCOUNT = "1000-CASH"
RECEIVABLE_ACCOUNT = "1200-ACCOUNTS-RECEIVABLE"
REVENUE_ACCOUNT = "4000-SUBSCRIPTION-REVENUE"
ADJUSTMENT_ACCOUNT = "4900-REVENUE-ADJUSTMENT"
DEBIT, CREDIT = "DEBIT", "CREDIT"
JE_TYPES = ("AUTO_INVOICE", "AUTO_PAYMENT", "MANUAL_ADJUSTMENT")
CLEAR_TEXT_ROLES = ("RL_ADMIN", "RL_TRANSFORMER", "RL_REVENUE_CONTROLLER")
ALL_ENTITY_ROLES = (*CLEAR_TEXT_ROLES, "RL_BI_READER")
ANALYST_ROLE = "RL_FINANCE_ANALYST"
WAREHOUSES = ("RL_LOADING_WH", "RL_TRANSFORMING_WH", "RL_BI_WH", "RL_CI_WH")
MASK = "***MASKED***"
OPEN_END = "9999-12-31"
LOOKBACK_DAYS = 60
COST_WINDOW_DAYS = 90
BILLING_PERIOD_DAYS = 30
# -------------------------------------------------------------------------------------------------
