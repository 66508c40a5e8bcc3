"""Every registered query against its SQL twin, and the identities over the derived tables."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from verify import TABLES, normal

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return db


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.LLM_QUERIES)))
def test_query_matches_sql(spark, database, name):
    df = entry.queries()[name](spark, FOLDER)
    mine = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan
    cursor = database.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert normal(mine, df.columns) == normal(cursor.fetchall(), names)


@pytest.mark.parametrize("name", entry.FAULTS)
def test_planted_faults_are_found(spark, name):
    assert not entry.queries()[name](spark, FOLDER).isEmpty()


def test_recent_payments_read_their_dates_only(spark):
    plan = entry.plan_for(spark, FOLDER)
    text = plan.affected_keys(entry.RUN_DATE)._jdf.queryExecution().executedPlan().toString()
    payments = [line for line in text.split("\n")
                if "payment_date" in line and "FileScan" in line]
    assert payments and all("GreaterThanOrEqual(payment_date" in line
                            or "GreaterThanOrEqual(_loaded_at" in line for line in payments)


def test_a_tile_reads_one_month_of_the_mart(spark):
    plan = entry.plan_for(spark, FOLDER)
    tile = entry.dashboard.arr_by_segment(plan.account_mart, plan.latest_month)
    text = tile._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.split("\n") if "FileScan" in line]
    month = plan.latest_month.isoformat()
    assert len(scans) == 1 and re.search(rf"PartitionFilters: .*month_end_date#\d+ = {month}",
                                         scans[0])


def test_movements_shuffle_contract_months_once(spark):
    """At scale the window over a contract and the join of its opening history share a shuffle."""
    plan = entry.plan_for(spark, FOLDER)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan.movements._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_contract = re.findall(r"Exchange hashpartitioning\(contract_id", text)
    assert len(by_contract) == 2
    assert "BroadcastHashJoin [_prior_month" in re.sub(r"#\d+L?", "", text)


def test_entry(spark):
    assert entry.entry(spark).count() > 70
