"""Findings of the fourth review: what stays on disk on the way, and what a report counts."""

import os
import time

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators import reconcile
from tallyspark.plans import checks
from tallyspark.plans.daily import DailyReconciliation
from tallyspark.plans.pipeline import RevenuePlan
from tallyspark.session import shuffles_dropped, stage_table, working_folder
from tallyspark.sources import facts as layout
from tallyspark.sources.facts import MONTH, FactTables, by_month, own_lines, slices
from tallyspark.sources.star import StarTables
from test_reconcile import build, rates, table  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {n for n in names if n.startswith("shuffle_")}


def laid(facts):
    put = lambda df, name: stage_table(by_month(df, name), name, [MONTH])
    return reconcile.Facts(
        put(facts.invoices, "invoices"), put(facts.credit_memos, "credit_memos"),
        put(facts.landed_payments, "payments"),
        put(own_lines(facts.gl_journal_entries, facts.invoices), "gl_journal_entries"),
        facts.accounts)


# -- F1, F2 ----------------------------------------------------------------------------------------
def test_a_row_is_counted_once_for_each_key_set_and_once_if_it_fails(frame):
    df = frame("id string, day date, kind string", ("a", "2024-01-01", "x"), (None, None, "z"),
               ("b", "2024-01-02", None), ("b", "2024-01-02", None), (None, None, "x"))
    declared = checks.Checks(not_null=("id", "kind"), unique=("id",), combination=("id", "day"),
                             accepted={"kind": ("x",)})
    profile = checks.key_profile(df, declared, [("id",), ("id", "day")])
    assert profile.agg(F.sum("n")).first()[0] == 2 * 5 + 4
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert "sum(" not in plan and "array<" not in plan.split("Exchange")[0].split("HashAggregate")[-1]
    report = {(r.check_name, r.column_name): r.violations
              for r in checks.check_report({"t": df}, {"t": declared}).collect()}
    assert report == {("not_null", "id"): 2, ("not_null", "kind"): 2,
                      ("accepted_values", "kind"): 1, ("unique", "id"): 1,
                      ("unique_combination", "id, day"): 2}


# -- F3 to F7 --------------------------------------------------------------------------------------
def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    staged = stage_table(spark.range(1000).groupBy(F.col("id") % 7).count(), "t")
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and staged.count() == 7
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    with pytest.raises(ValueError), shuffles_dropped(spark):
        raise ValueError
    assert spark.conf.get(name, None) == was


def test_slices_hold_each_row_once(spark, frame, monkeypatch):
    monkeypatch.setattr(layout, "SLICE_ROWS", 3)
    df = frame("k string, n int", *[(f"k{i % 5}" if i % 4 else None, i) for i in range(20)])
    cut = slices(df, "k")
    assert len(cut) == layout.MOST_SLICES and len(slices(df.limit(2), "k")) == 1
    parts = [rows(chosen(df)) for chosen in cut]
    assert sorted(sum(parts, []), key=str) == rows(df)
    keys = [{k for k, _ in part} for part in parts]
    assert sum(map(len, keys)) == len(set().union(*keys)) == 6


def test_facts_laid_out_in_slices_are_the_same(spark, monkeypatch):
    plan = RevenuePlan(StarTables(spark, FOLDER).land())
    whole = plan.facts
    monkeypatch.setattr(layout, "SLICE_ROWS", 1500)
    sliced = RevenuePlan(plan.landed).facts
    assert len({f.split("/")[-3] for f in sliced.gl_journal_entries.inputFiles()}) == 4
    for name in ("landed_payments", "gl_journal_entries"):
        one, other = getattr(whole, name), getattr(sliced, name)
        assert rows(one.select(F.xxhash64(*one.columns))) == rows(
            other.select(F.xxhash64(*one.columns)))


@pytest.mark.parametrize("owned", [True, False])
def test_steps_of_months_change_no_figure(build, rates, monkeypatch, owned):  # noqa: F811
    memo = ("I2", "A1", "2024-01-28", "2024-06-30", "USD", 3, "2024-06-30")
    facts = laid(build(memo, payments=[("P7", "I2", "A1", None, 30, "USD", "2024-07-01")]))
    if not owned:
        lines = facts.gl_journal_entries.drop("account_id")
        facts = reconcile.Facts(facts.invoices, facts.credit_memos, facts.landed_payments, lines,
                                facts.accounts)
    monkeypatch.setattr(reconcile, "STEP_ROWS", 2)
    staged = []

    def stage(df, name):
        staged.append(stage_table(df, name))
        return staged[-1]

    stepped = reconcile.revenue_reconciliation_in_steps(facts, rates, stage)
    assert len(staged) > 1
    assert table(stepped) == table(reconcile.revenue_reconciliation(facts, rates))
    assert stepped.select(*reconcile.KEY).distinct().count() == stepped.count()


def test_the_first_daily_run_goes_in_steps(spark, build, rates, monkeypatch, tmp_path):  # noqa: F811
    facts = laid(build())
    monkeypatch.setattr(reconcile, "STEP_ROWS", 2)
    steps = []
    whole = reconcile.revenue_reconciliation
    monkeypatch.setattr(reconcile, "revenue_reconciliation",
                        lambda *a: steps.append(a) or whole(*a))
    daily = DailyReconciliation(spark, str(tmp_path))
    daily.run(facts, rates, "run-1", "2024-07-01", "2024-07-01 05:00:00")
    assert len(steps) > 1
    assert table(daily.reconciliation()) == table(whole(facts, rates))


def test_landing_keeps_no_lines_in_blocks_and_nothing_staged(spark, build, tmp_path, monkeypatch):  # noqa: F811
    plain = build()
    frames = {"invoices": plain.invoices, "credit_memos": plain.credit_memos,
              "payments": plain.landed_payments, "gl_journal_entries": plain.gl_journal_entries}
    landed = FactTables(spark, str(tmp_path), {n: df.schema for n, df in frames.items()})
    monkeypatch.setattr(DataFrame, "persist", lambda *_: pytest.fail("lines are persisted"))
    staged = lambda: {n for n in os.listdir(working_folder(spark)) if n.startswith("owned_lines")}
    before = staged()
    landed.land("1", frames)
    assert staged() == before
    lines = landed.read("gl_journal_entries")
    assert lines.count() == plain.gl_journal_entries.count()
    assert rows(lines.where("account_id IS NULL").select("invoice_id")) == [("GONE",)]
