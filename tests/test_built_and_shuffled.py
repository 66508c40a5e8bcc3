"""Findings of the third review: what a query builds and shuffles on its way."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyspark.functions.ordered import with_rank
from tallyspark.operators import arr
from tallyspark.plans import checks
from tallyspark.plans.pipeline import RevenuePlan
from tallyspark.sources.star import StarTables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark, monkeypatch):
    """A plan whose tables have not landed yet, behind all queries of a test."""
    fresh = RevenuePlan(StarTables(spark, FOLDER).land())
    monkeypatch.setattr(entry, "plan_for", lambda *_: fresh)
    return fresh


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_governed_view_builds_its_own_mart_alone(spark, plan):
    entry.queries()["dim_customer_for_admin"](spark, FOLDER)
    entry.queries()["portfolio_for_analyst"](spark, FOLDER)
    assert not {"facts", "reconciliation"} & set(plan.__dict__)
    assert not {"payments", "gl_journal_entries"} & set(plan.landed._tables)


def test_freshness_lands_no_table(spark, plan):
    report = entry.queries()["freshness_report"](spark, FOLDER).collect()
    assert not plan.landed._tables
    landed = entry.wide(checks.freshness_report(plan.landed, entry.FRESHNESS_AS_OF)).collect()
    assert sorted(map(str, report)) == sorted(map(str, landed))


def test_tiles_of_the_newest_month_build_no_other(spark, plan):
    tiles = {c: entry.queries()[f"arr_by_{c}"](spark, FOLDER).collect()
             for c in ("segment", "region")}
    assert not {"contract_life", "account_mart", "movements"} & set(plan.__dict__)
    for c, tile in tiles.items():
        mart = getattr(entry.dashboard, f"arr_by_{c}")(plan.account_mart, plan.latest_month)
        assert tile == entry.wide(mart).collect()


def test_the_full_reconciliation_lays_out_no_facts(spark, plan):
    whole = rows(entry.to_cents(plan.reconciliation))
    assert "facts" not in plan.__dict__
    laid = entry.reconcile.revenue_reconciliation(plan.facts, plan.fx)
    assert whole == rows(entry.to_cents(laid))


def test_movements_leave_contract_months_where_they_are(spark, plan):
    """Only the first months of contracts are shuffled to their opening history."""
    plan.movements  # noqa: B018
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan.movements._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" not in text
    shuffled = re.findall(r"Exchange hashpartitioning\(contract_id", text)
    assert len(shuffled) == 2
    bare = re.sub(r"#\d+L?", "", text)
    assert "(contract_month_seq = 1)" in bare and "NOT (contract_month_seq = 1)" in bare


def test_contracts_of_an_account_with_two_places_count_for_each(spark, plan):
    again = plan.accounts.where("account_id LIKE '%1'").withColumns(
        {"region": F.lit("XX"), "legal_entity": F.lit("Other")})
    plan.accounts = plan.accounts.unionByName(again).localCheckpoint()
    history = arr.account_arr_monthly(plan.contract_arr)
    opening = arr.openings(history, plan.contract_spans)
    assert opening.count() > opening.select("contract_id").distinct().count()
    plain = arr.with_prior_month(plan.contract_arr).join(opening, "contract_id", "left")
    bridge = arr.opening_bridge(plan.contract_life, opening, plan.fx)
    pick = ("contract_id", "month_end_date", "arr_usd", "region")
    assert rows(bridge.select(*pick)) == rows(plain.select(*pick))
    month = plan.latest_month
    totals = plan.account_waterfall.where(F.col("month_end_date") == F.lit(month))
    assert rows(plan.newest_account_arr.select("account_id", "region", "account_arr_usd")) == rows(
        totals.select("account_id", "region", "account_arr_usd"))


def test_ranking_without_a_hot_key_shuffles_once_by_the_key(spark):
    df = spark.createDataFrame([(k, i) for k in (1, 2, None) for i in (3, 1, 2)], "k int, i int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = with_rank(df, ["k"], ["i"], "place", "n")
        text = ranked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 1 and "Join" not in text
    assert ranked.schema["place"].dataType.typeName() == "long"
    assert rows(ranked) == rows(with_rank(df, ["k"], ["i"], "place", "n", hot_rows=1))


def test_check_report_writes_the_keys_it_looks_up_alone(spark):
    parents = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], "id string, n int")
    children = spark.createDataFrame([("a", 1), ("c", 2), ("c", 2)], "id string, n int")
    declared = {"p": checks.Checks(unique=("id",), combination=("id", "n")),
                "c": checks.Checks(unique=("n",), parents={"id": ("p", "id")})}
    staged = []

    def stage(df, name):
        staged.append(df.count())
        return df

    report = checks.check_report({"p": parents, "c": children}, declared, stage)
    # Rows, two ids, no pair that comes twice; rows, two ids, one number that comes twice.
    assert staged == [3, 4]
    assert {(r.table_name, r.check_name): r.violations for r in report.collect()} == {
        ("p", "unique"): 1, ("p", "unique_combination"): 0, ("c", "unique"): 1,
        ("c", "relationships"): 1}


def test_the_restatement_log_lays_out_no_facts(spark, plan):
    log = rows(entry.queries()["restatement_log"](spark, FOLDER))
    assert log and "facts" not in plan.__dict__
    plan.facts  # noqa: B018
    assert log == rows(entry.queries()["restatement_log"](spark, FOLDER))
