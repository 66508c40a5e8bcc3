from datetime import timedelta

import pytest
from conftest import d, rows, usd
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.operators import billing, cost, dashboard, governance, quality
from tallyspark.plans import checks

VERSION = ("contract_id string, version_number long, account_id string, "
           "effective_start_date date, effective_end_date_exclusive date, "
           "arr_amount decimal(18,2), currency string, seats long, plan_tier string")


def test_billing_schedule(frame):
    v = frame(VERSION,
              ("C1", 1, "A", "2024-01-01", "2024-03-01", 100, "USD", 3, "Growth"),
              ("C1", 2, "A", "2024-03-01", "9999-12-31", 240, "USD", 0, "Starter"),
              ("C2", 1, "A", "2024-01-01", "2024-01-31", 12, "USD", 1, "Growth"),
              ("C3", 1, "A", "2024-01-01", "2024-02-01", 0, "USD", 1, "Growth"),
              ("C4", 1, "A", "2024-05-01", "9999-12-31", 12, "USD", 1, "Growth"))
    schedule = billing.billing_schedule(v, "2024-04-30")
    assert rows(schedule, "contract_id", "invoice_date", "amount") == [
        ("C1", d("2024-01-01"), usd("8.33")), ("C1", d("2024-01-31"), usd("8.33")),
        ("C1", d("2024-03-01"), usd("20.00")), ("C1", d("2024-03-31"), usd("20.00")),
        ("C2", d("2024-01-01"), usd("1.00"))]
    assert schedule.select("invoice_id").distinct().count() == 5
    lines = billing.invoice_lines(schedule)
    assert rows(lines, "description", "unit_amount")[0] == ("Growth plan - 1 seats", usd("1.0000"))
    assert ("Growth plan - 3 seats", usd("2.7767")) in rows(lines, "description", "unit_amount")
    assert ("Starter plan - 0 seats", usd("20.0000")) in rows(lines, "description", "unit_amount")


def test_ledger(frame):
    invoices = frame("invoice_id string, invoice_date date, amount decimal(18,2), currency string",
                     ("I1", "2024-01-01", 10, "USD"))
    payments = frame("payment_id string, invoice_id string, payment_date date, "
                     "amount decimal(18,2), currency string",
                     ("P1", "I1", "2024-01-09", 4, "USD"), ("P2", "I1", "2024-01-09", 4, "USD"),
                     ("P3", "I1", "2024-01-09", 6, "USD"))
    adjustments = frame("invoice_id string, posting_date date, currency string, adjustment decimal(18,2)",
                        ("I1", "2024-01-01", "USD", "2.50"), ("I2", "2024-01-01", "USD", "-1"),
                        ("I3", "2024-01-01", "USD", 0))
    gl = billing.gl_postings(invoices, payments).unionByName(
        billing.post_manual_adjustments(adjustments))
    assert rows(gl, "reference_id", "gl_account", "debit_credit", "amount") == [
        ("I1", "1000-CASH", "DEBIT", usd("4.00")), ("I1", "1000-CASH", "DEBIT", usd("6.00")),
        ("I1", "1200-ACCOUNTS-RECEIVABLE", "CREDIT", usd("4.00")),
        ("I1", "1200-ACCOUNTS-RECEIVABLE", "CREDIT", usd("6.00")),
        ("I1", "1200-ACCOUNTS-RECEIVABLE", "DEBIT", usd("10.00")),
        ("I1", "4000-SUBSCRIPTION-REVENUE", "CREDIT", usd("10.00")),
        ("I1", "4000-SUBSCRIPTION-REVENUE", "CREDIT", usd("2.50")),
        ("I1", "4900-REVENUE-ADJUSTMENT", "DEBIT", usd("2.50")),
        ("I2", "4000-SUBSCRIPTION-REVENUE", "DEBIT", usd("1.00")),
        ("I2", "4900-REVENUE-ADJUSTMENT", "CREDIT", usd("1.00"))]
    assert gl.select("je_id").distinct().count() == gl.count()
    assert billing.gl_is_balanced(gl)
    assert not billing.gl_is_balanced(gl.where("gl_account <> '1000-CASH'"))


def test_co_termination(frame):
    contracts = frame("contract_id string, account_id string, co_termination_group string",
                      ("C1", "A", None), ("C1", "A", None), ("C2", "A", None), ("C3", "B", "x"))
    assert rows(billing.co_termination_group(contracts), "contract_id", "co_termination_group") == [
        ("C1", "A"), ("C1", "A"), ("C2", "A"), ("C3", None)]


@pytest.fixture
def portfolio(frame):
    return frame("month_end_date date, total_arr_usd decimal(18,2), prior_total_arr_usd "
                 "decimal(18,2), new_arr_usd decimal(18,2), expansion_arr_usd decimal(18,2), "
                 "contraction_arr_usd decimal(18,2), churn_arr_usd decimal(18,2), "
                 "reactivation_arr_usd decimal(18,2), fx_impact_usd decimal(18,2)",
                 ("2024-01-31", 100, None, 100, 0, 0, 0, 0, 0),
                 ("2024-02-29", 125, 100, 40, 10, -5, -30, 7, 3))


def test_headline_and_cards(portfolio):
    assert rows(dashboard.headline_arr(portfolio), "total_arr_usd", "mom_change_usd",
                "mom_change_pct") == [(125, 25, 25)]
    first = portfolio.where("month_end_date = '2024-01-31'")
    assert rows(dashboard.headline_arr(first), "mom_change_usd", "mom_change_pct") == [(None, None)]
    assert rows(dashboard.kpi_cards(portfolio), "total_arr_usd", "new_plus_expansion_usd",
                "contraction_plus_churn_usd") == [(125, 50, -35)]


def test_bridge_tiles(portfolio):
    tile = dashboard.waterfall_bridge_tile(portfolio).orderBy("sort_order").collect()
    assert [(r.category, int(r.base_invisible), int(r.bar_visible), int(r.raw_delta)) for r in tile] == [
        ("Starting ARR", 0, 100, 100), ("New", 100, 40, 40), ("Expansion", 140, 10, 10),
        ("Reactivation", 150, 7, 7), ("Contraction", 152, 5, -5), ("Churn", 122, 30, -30),
        ("FX Impact", 122, 3, 3), ("Ending ARR", 0, 125, 125)]
    table = dashboard.bridge_running_total(portfolio)
    got = [(r.component, int(r.running_total)) for r in table.orderBy("position").collect()]
    assert got == [("1. Starting ARR", 100), ("2. New", 140), ("3. Expansion", 150),
                   ("4. Reactivation", 157), ("5. Contraction", 152), ("6. Churn", 122),
                   ("7. FX Impact", 125), ("8. Ending ARR", 125)]
    assert dashboard.movement_components(table).count() == 6
    first = dashboard.bridge_running_total(portfolio.where("prior_total_arr_usd is null"))
    assert [r.running_total for r in first.orderBy("position").collect()] == [None] * 6 + [100, 100]


def test_trends_and_breakdowns(portfolio, frame):
    long = dashboard.arr_trend_by_movement(portfolio)
    assert long.count() == 10
    assert rows(long.where("movement_type = 'Churn'"), "amount_usd") == [(-30,), (0,)]
    assert dashboard.arr_trend_wide(portfolio).columns == [
        "month_end_date", "New", "Expansion", "Reactivation", "Contraction", "Churn"]
    accounts = frame("month_end_date date, segment string, region string, account_arr_usd decimal(18,2)",
                     ("2024-01-31", "SMB", "US", 99), ("2024-02-29", "SMB", "US", 5),
                     ("2024-02-29", "Enterprise", "US", 20), ("2024-02-29", "SMB", "EU", 4))
    assert [tuple(r) for r in dashboard.arr_by_segment(accounts).collect()] == [
        ("Enterprise", 20), ("SMB", 9)]
    assert [tuple(r) for r in dashboard.arr_by_region(accounts).collect()] == [("US", 25), ("EU", 4)]


@pytest.mark.parametrize("role, user, ids, clear", [
    ("RL_ADMIN", "x", ["1", "2", "3"], True), ("RL_TRANSFORMER", "x", ["1", "2", "3"], True),
    ("RL_REVENUE_CONTROLLER", "x", ["1", "2", "3"], True),
    ("RL_BI_READER", "x", ["1", "2", "3"], False), ("RL_FINANCE_ANALYST", "us", ["1"], False),
    ("RL_FINANCE_ANALYST", "both", ["1", "2"], False),
    ("RL_FINANCE_ANALYST", "nobody", [], False), ("NEW_ROLE", "us", ["1"], False)])
def test_governance(spark, frame, role, user, ids, clear):
    dim = frame("account_id string, billing_contact_name string, billing_contact_email string, "
                "tax_id string, address_line1 string, city string, legal_entity string",
                ("1", "Jo", "jo@a.com", "T", "S", "C", "Inc"), ("2", "Al", None, "T", "S", "C", "BV"),
                ("3", "No", "n@b.c", "T", "S", "C", None))
    mapping = governance.analyst_entity_access(spark, [
        ("us", "Inc", None), ("us", "Inc", None), ("both", "Inc", None), ("both", "BV", None)])
    portfolio = frame("total_arr_usd long", (5,))
    views = governance.governed_views(
        {"dim_customer": dim, "fct_arr_waterfall_portfolio_monthly": portfolio}, mapping, role, user)
    seen = spark.table("dim_customer")
    assert [r[0] for r in rows(seen, "account_id")] == ids
    assert seen.columns == dim.columns
    assert {r[0] for r in rows(seen, "billing_contact_name")} <= (
        {"Jo", "Al", "No"} if clear else {"***MASKED***"})
    assert rows(views["fct_arr_waterfall_portfolio_monthly"], "total_arr_usd") == [(5,)]


def test_cost(frame):
    tag = '{"app": "dbt", "target": "prod", "schema": "marts", "model": "m1"}'
    history = frame("query_id string, warehouse_name string, query_tag string, "
                    "start_time timestamp_ntz, total_elapsed_time long",
                    *[(str(i), w, t, s, ms) for i, (w, t, s, ms) in enumerate([
                        ("RL_BI_WH", tag, "2024-01-05 01:00:00", 300),
                        ("RL_BI_WH", tag, "2024-01-05 02:00:00", 100),
                        ("RL_BI_WH", "{broken", "2024-01-05 03:00:00", 400),
                        ("RL_BI_WH", None, "2024-01-05 03:00:00", 999),
                        ("RL_BI_WH", "", "2024-01-05 03:00:00", 999),
                        ("OTHER", tag, "2024-01-05 03:00:00", 999),
                        ("RL_CI_WH", tag, "2024-01-05 03:00:00", 0),
                        ("RL_BI_WH", tag, "2024-01-06 03:00:00", 50),
                        ("RL_BI_WH", tag, "2023-01-06 03:00:00", 50)])])
    metering = frame("warehouse_name string, start_time timestamp_ntz, credits_used decimal(18,4)",
                     ("RL_BI_WH", "2024-01-05 00:00:00", 1), ("RL_BI_WH", "2024-01-05 01:00:00", 1),
                     ("RL_CI_WH", "2024-01-05 00:00:00", 1))
    out = cost.cost_by_layer_daily(history, metering, as_of="2024-01-31")
    assert rows(out, "warehouse_name", "query_date", "pipeline_layer", "dbt_model", "query_count",
                "elapsed_ms", "estimated_credits") == [
        ("RL_BI_WH", d("2024-01-05"), "invocation_level", None, 1, 400, usd("1.0000")),
        ("RL_BI_WH", d("2024-01-05"), "marts", "m1", 2, 400, usd("1.0000")),
        ("RL_BI_WH", d("2024-01-06"), "marts", "m1", 1, 50, usd("0.0000")),
        ("RL_CI_WH", d("2024-01-05"), "marts", "m1", 1, 0, None)]


def test_quality_checks(frame):
    df = frame("k string, v string", ("a", "x"), ("a", "y"), (None, "z"), (None, None), ("b", "x"))
    assert quality.not_null(df, "k").count() == 2
    assert rows(quality.unique(df, "k"), "k", "n_records") == [("a", 2)]
    assert rows(quality.unique_combination(df, ["k"]), "k", "n_records") == [(None, 2), ("a", 2)]
    assert rows(quality.accepted_values(df, "v", ["x", "y"]), "v", "n_records") == [("z", 1)]
    parent = frame("id string", ("a",), (None,))
    assert rows(quality.relationships(df, "k", parent, "id"), "k", "n_records") == [("b", 1)]


@pytest.mark.parametrize("as_of, status", [
    ("2024-01-02 06:00:00", "pass"), ("2024-01-02 06:00:01", "warn"),
    ("2024-01-03 00:00:01", "error")])
def test_freshness(frame, as_of, status):
    df = frame("t timestamp_ntz", ("2024-01-01 00:00:00",), (None,))
    limits = timedelta(hours=30), timedelta(hours=48)
    assert quality.freshness(df, "t", *limits, as_of).first().status == status
    assert quality.freshness(df.limit(0), "t", *limits, as_of).first().status == "error"


def test_gaps_are_found(frame):
    bridge = frame("contract_id string, month_end_date date, arr_usd decimal(18,2), "
                   "prior_arr_usd_filled decimal(18,2), real_component_usd decimal(18,2), "
                   "fx_component_usd decimal(18,2)",
                   ("C1", "2024-01-31", 10, 0, 10, 0), ("C2", "2024-01-31", 10, 5, "4.99", 0),
                   ("C3", "2024-01-31", 10, 5, "4.98", 0))
    assert rows(quality.decomposition_gap(bridge), "contract_id", "reconciliation_gap") == [
        ("C3", usd("0.02"))]
    assert quality.decomposition_gap(bridge, tolerance=0.001).count() == 2
    memos = frame("credit_memo_id string, invoice_id string, issue_date date, system_entry_date date",
                  ("M1", "I", "2024-01-01", "2024-01-31"), ("M2", "I", "2024-01-01", "2024-01-01"))
    assert rows(quality.credit_memo_lag(memos), "credit_memo_id", "lag_days", "is_late") == [
        ("M1", 30, True), ("M2", 0, False)]


def test_declared_checks(frame):
    assert sum(map(len, checks.SOURCE_CHECKS.values())) == 60
    assert sum(map(len, checks.MODEL_CHECKS.values())) == 89
    for name, declared in checks.SOURCE_CHECKS.items():
        named = {*declared.not_null, *declared.unique, *declared.accepted}
        assert named <= set(S.LANDED[name].fieldNames())
    tables = {"invoices": frame("invoice_id string, contract_id string, account_id string, "
                                "invoice_date date, currency string, amount decimal(18,2)",
                                ("I1", None, "A", "2024-01-01", "GBP", 1),
                                ("I1", "C", "A", "2024-01-01", "USD", 1))}
    report = checks.check_report(tables, checks.SOURCE_CHECKS)
    assert report.count() == len(checks.SOURCE_CHECKS["invoices"])
    bad = report.where(F.col("violations") > 0)
    assert rows(bad, "check_name", "column_name", "violations") == [
        ("accepted_values", "currency", 1), ("not_null", "contract_id", 1),
        ("unique", "invoice_id", 1)]
