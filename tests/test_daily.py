"""Landing in batches, versions by partition, retention, and the daily run."""

import os
import random
import re
import threading
from datetime import datetime

import pytest
from conftest import d, rows, usd
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.functions.asof import as_of
from tallyspark.functions.ordered import ordinals, with_next
from tallyspark.operators import reconcile, restate
from tallyspark.plans import checks
from tallyspark.plans.daily import DailyReconciliation
from tallyspark.session import stage_table, staging_area
from tallyspark.sources import snapshots, tables
from tallyspark.sources.facts import MONTH, FactTables, by_month, own_lines
from tallyspark.sources.files import create_once
from tallyspark.streaming import landing as streams
from test_reconcile import GL, INVOICE, MEMO, PAYMENT, build, rates, table  # noqa: F401


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- owned ledger lines and facts by month ---------------------------------------------------------
def laid(facts, stage=stage_table):
    """The same facts as the pipeline lays them out."""
    def put(df, name):
        return stage(by_month(df, name), name, [MONTH])
    return reconcile.Facts(
        put(facts.invoices, "invoices"), put(facts.credit_memos, "credit_memos"),
        put(facts.landed_payments, "payments"),
        put(own_lines(facts.gl_journal_entries, facts.invoices), "gl_journal_entries"),
        facts.accounts)


def test_layout_changes_no_figure(build, rates, frame):  # noqa: F811
    memo = ("I2", "A1", "2024-01-28", "2024-06-30", "USD", 3, "2024-06-30")
    plain = build(memo, payments=[("P7", "I2", "A1", None, 30, "USD", "2024-07-01")])
    facts = laid(plain)
    assert table(reconcile.revenue_reconciliation(facts, rates)) == table(
        reconcile.revenue_reconciliation(plain, rates))
    for as_of in ("2024-01-01", "2024-07-01", "2030-01-01"):
        keys = reconcile.affected_keys(facts, as_of)
        assert rows(keys, *reconcile.KEY) == rows(
            reconcile.affected_keys(plain, as_of), *reconcile.KEY)
        assert table(reconcile.revenue_reconciliation_for(keys, facts, rates)) == table(
            reconcile.revenue_reconciliation_for(keys, plain, rates))


def test_touched_run_reads_its_months_and_no_invoice_for_the_ledger(build, rates, frame):  # noqa: F811
    facts = laid(build())
    keys = stage_table(frame("month_start date, legal_entity string", ("2024-02-01", "Inc")), "keys")
    plan = plan_of(reconcile.revenue_reconciliation_for(keys, facts, rates))
    scans = re.findall(r"FileScan parquet .*?PartitionFilters: \[(.*?)\], PushedFilters", plan)
    of_facts = [s for s in scans if "_month" in s]
    assert len(of_facts) == 4 and all("2024-02-01" in s or "19754" in s for s in of_facts)
    # Two scans would name invoices if the ledger still looked its owner up.
    touched = plan_of(reconcile.affected_keys(facts, "2024-07-01"))
    assert len(re.findall(r"FileScan parquet .*?/invoices-", touched)) <= 1
    assert not re.search(r"invoice_id#\d+\], \[invoice_id#\d+\]", plan + touched)


def fact_tables(spark, facts, root):
    frames = {"invoices": facts.invoices, "credit_memos": facts.credit_memos,
              "payments": facts.landed_payments, "gl_journal_entries": facts.gl_journal_entries}
    return FactTables(spark, root, {n: df.schema for n, df in frames.items()}), frames


def test_lines_wait_for_their_invoice(spark, build, rates, tmp_path):  # noqa: F811
    plain = build()
    landed, frames = fact_tables(spark, plain, str(tmp_path))
    one = F.col("invoice_id") == "I1"
    landed.land("01", {"invoices": plain.invoices.where(~one),
                       "gl_journal_entries": plain.gl_journal_entries})
    owner = lambda: rows(landed.read("gl_journal_entries"), "invoice_id", "account_id")
    assert owner() == [("GONE", None), ("I1", None), ("I1", None), ("I1", None), ("I2", "A1")]
    late = {"invoices": plain.invoices.where(one), "credit_memos": plain.credit_memos,
            "payments": plain.landed_payments}
    for _ in range(3):
        landed.land("02", late)
        assert owner() == [("GONE", None), ("I1", "A1"), ("I1", "A1"), ("I1", "A1"), ("I2", "A1")]
        assert landed.read("invoices").count() == 3
    facts = reconcile.Facts(*[landed.read(n) for n in frames], plain.accounts)
    assert table(reconcile.revenue_reconciliation(facts, rates)) == table(
        reconcile.revenue_reconciliation(plain, rates))
    gone = frames["invoices"].limit(1).withColumn("invoice_id", F.lit("GONE"))
    landed.land("03", {"invoices": gone})
    assert ("GONE", "A1") in owner() or ("GONE", "NOENT") in owner()
    assert landed.read("gl_journal_entries").count() == 5
    assert (tmp_path / "invoices" / "landed_batch=02" / "_month=2024-01-01").is_dir()


# -- batches that come again -----------------------------------------------------------------------
def test_a_batch_landed_again_replaces_itself(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    ddl = "k string, day date, v long"
    first = frame(ddl, ("a", "2024-01-01", 1), (None, "2024-01-01", 2))
    second = frame(ddl, ("a", "2024-01-01", 9), ("b", "2024-01-02", 3), (None, "2024-01-02", 4),
                   (None, "2024-01-02", 4))
    for batch, source in (("1", first), ("2", second), ("2", second), ("1", first), ("2", second)):
        tables.insert_if_absent(spark, path, source, ["k"], partition_by=["day"], batch=batch)
    assert rows(spark.read.parquet(path), "k", "v") == [
        (None, 2), (None, 4), (None, 4), ("a", 1), ("b", 3)]


def test_a_replayed_stream_batch_lands_once(spark, tmp_path):
    """The commit of the batch is lost, as in a crash after its rows were written."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "credit_memo_id,invoice_id,account_id,issue_date,system_entry_date,currency,amount,reason\n"
        "NULL,I1,A1,2024-01-02,2024-01-02,USD,1,x\nCM-1,I1,A1,2024-01-02,2024-01-02,USD,2,x\n")

    def run(checkpoint="cp"):
        streams.stream_landing(
            spark, str(folder), S.LANDED["credit_memos"], ["credit_memo_id"],
            str(tmp_path / "t"), str(tmp_path / checkpoint)).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "t")), "credit_memo_id", "amount")

    once = run()
    assert once == [(None, usd("1")), ("CM-1", usd("2"))]
    for name in ("0", ".0.crc"):
        os.remove(tmp_path / "cp" / "commits" / name)
    assert run() == once
    # Another query over the same files is another delivery: its known key is skipped.
    assert run("other") == [(None, usd("1")), (None, usd("1")), ("CM-1", usd("2"))]


def test_a_payment_rewrites_its_bucket_alone(spark, frame, tmp_path):
    raw, target = str(tmp_path / "raw"), tmp_path / "staged"
    columns = ("payment_id string, invoice_id string, account_id string, payment_date date, "
               "amount decimal(18,2), currency string, _loaded_at timestamp_ntz")

    def arrive(*payments):
        tables.append_log(frame(columns, *payments).coalesce(1), raw)
        streams.stream_payments_staging(spark, raw, str(target), str(tmp_path / "cp"),
                                        grain="month", buckets=4).awaitTermination()
        return {str(p.relative_to(target)) for p in target.rglob("*.parquet")}

    before = arrive(*[(f"P{i}", f"I{i}", "A1", f"2024-0{1 + i % 3}-05", 10, "USD", "2024-03-05")
                      for i in range(40)])
    after = arrive(("P", "I7", "A1", "2024-02-05", 10, "USD", "2024-03-06"))
    assert len({p.rpartition("/")[0] for p in after - before}) == 1
    assert {p.rpartition("/")[0] for p in after} == {p.rpartition("/")[0] for p in before}
    staged = spark.read.parquet(str(target))
    assert rows(staged.where("invoice_id = 'I7'"), "payment_id") == [("P",)] and staged.count() == 40


# -- versions --------------------------------------------------------------------------------------
VALUES = "m date, e string, v long"


def test_replace_writes_the_touched_partitions(spark, frame, tmp_path):
    root = str(tmp_path)
    first = frame(VALUES, ("2024-01-01", "X", 1), ("2024-01-01", None, 2), ("2024-02-01", "X", 3),
                  (None, "X", 4))
    snapshots.snapshot_write(first, root, "r1", "2024-03-01 00:00:00", partition_by="m")
    fresh = frame(VALUES, ("2024-02-01", "X", 30), ("2024-03-01", "Y", 5))
    snapshots.snapshot_replace(fresh, root, "r2", ["m", "e"], "2024-03-02 00:00:00")
    read = lambda **k: rows(snapshots.snapshot_read(spark, root, **k), "v")
    assert read() == [(2,), (1,), (30,), (4,), (5,)] or sorted(read()) == [(1,), (2,), (4,), (5,), (30,)]
    assert sorted(read(run_id="r1")) == [(1,), (2,), (3,), (4,)]
    assert sorted(read(before="2024-03-02 00:00:00")) == [(1,), (2,), (3,), (4,)]
    second = next((tmp_path / "versions").glob("r2-*"))
    assert sorted(p.name for p in second.iterdir() if p.is_dir()) == [
        "_part=2024-02-01", "_part=2024-03-01"]
    assert read(parts=[d("2024-03-01")]) == [(5,)] and read(parts=[None]) == [(4,)]
    with pytest.raises(FileExistsError):
        snapshots.snapshot_replace(fresh, root, "r2", ["m", "e"])
    with pytest.raises(ValueError):
        snapshots.snapshot_replace(fresh, root, "r3", ["e"])
    empty = frame(VALUES).limit(0)
    snapshots.snapshot_write(empty, root, "r4", "2024-03-04 00:00:00", partition_by="m")
    assert snapshots.snapshot_read(spark, root).schema == empty.schema and read() == []


def test_one_writer_of_a_run_wins(spark, frame, tmp_path):
    root = str(tmp_path)
    done, failed = [], []

    def write(value):
        try:
            snapshots.snapshot_write(frame("v long", (value,)), root, "r")
            done.append(value)
        except FileExistsError:
            failed.append(value)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(done) == 1 and len(failed) == 3
    assert rows(snapshots.snapshot_read(spark, root), "v") == [(done[0],)]
    assert snapshots.manifest(spark, root).count() == 1


def test_a_replacement_of_an_old_state_is_refused(spark, frame, tmp_path, monkeypatch):
    root = str(tmp_path)
    snapshots.snapshot_write(frame(VALUES, ("2024-01-01", "X", 1)), root, "r1", partition_by="m")
    plain = snapshots._written

    def meanwhile(df, folder, by):
        monkeypatch.setattr(snapshots, "_written", plain)
        snapshots.snapshot_replace(frame(VALUES, ("2024-01-01", "Y", 2)), root, "r2", ["m", "e"])
        return plain(df, folder, by)

    monkeypatch.setattr(snapshots, "_written", meanwhile)
    with pytest.raises(snapshots.Superseded):
        snapshots.snapshot_replace(frame(VALUES, ("2024-01-01", "Z", 3)), root, "r3", ["m", "e"])
    assert sorted(rows(snapshots.snapshot_read(spark, root), "e", "v")) == [("X", 1), ("Y", 2)]


def test_create_once(spark, tmp_path):
    path = str(tmp_path / "f" / "a.txt")
    assert create_once(spark, path, "one") and not create_once(spark, path, "two")
    assert open(path).read() == "one" and os.listdir(tmp_path / "f") == ["a.txt"]


def test_expiry(spark, frame, tmp_path):
    root = str(tmp_path)
    row = lambda m, v: frame(VALUES, (m, "X", v))
    snapshots.snapshot_write(frame(VALUES, ("2024-01-01", "X", 1), ("2024-02-01", "X", 2)), root,
                             "r1", "2024-03-01 00:00:00", partition_by="m")
    for i, day in ((2, "02"), (3, "03")):
        snapshots.snapshot_replace(row("2024-02-01", i * 10), root, f"r{i}", ["m", "e"],
                                   f"2024-03-{day} 00:00:00")
    (tmp_path / "versions" / "lost-1").mkdir()
    os.utime(tmp_path / "versions" / "lost-1", (1, 1))
    folders = lambda: sorted(p.name[:4] for p in (tmp_path / "versions").iterdir())
    # r1 was superseded on the 2nd, r2 on the 3rd.
    assert snapshots.expire(spark, root, 1, datetime(2024, 3, 3)) == ["r1"]
    with pytest.raises(LookupError, match="expired"):
        snapshots.snapshot_read(spark, root, run_id="r1")
    assert folders() == ["r1-" + folders()[0][3], "r2-" + folders()[1][3], "r3-" + folders()[2][3]]
    assert snapshots.expire(spark, root, 1, datetime(2024, 3, 3, 23)) == []
    first = next((tmp_path / "versions").glob("r1-*"))
    assert (first / "_part=2024-02-01").is_dir()
    # A day after, what only the expired version named is gone; the month it shares stays.
    assert snapshots.expire(spark, root, 1, datetime(2024, 3, 4, 1)) == ["r2"]
    assert not (first / "_part=2024-02-01").exists() and (first / "_part=2024-01-01").is_dir()
    snapshots.expire(spark, root, 1, datetime(2024, 3, 6))
    assert [n[:2] for n in folders()] == ["r1", "r3"]
    assert sorted(rows(snapshots.snapshot_read(spark, root), "v")) == [(1,), (30,)]
    assert snapshots.expire(spark, str(tmp_path / "none")) == []


# -- the daily run ---------------------------------------------------------------------------------
def test_daily_runs(spark, build, rates, tmp_path):  # noqa: F811
    memo = ("I2", "A1", "2024-01-28", "2024-06-30", "USD", 3, "2024-06-30")
    before, after = laid(build()), laid(build(memo))
    daily = DailyReconciliation(spark, str(tmp_path), keep_days=1)
    first = daily.run(before, rates, "run-1", "2024-06-20", "2024-06-20 05:00:00")
    assert first.touched_keys == 5 and first.expired == []
    for _ in range(2):
        report = daily.run(after, rates, "run-2", "2024-07-01", "2024-07-01 05:00:00")
        assert report.touched_keys == 2
    assert table(daily.reconciliation()) == table(reconcile.revenue_reconciliation(after, rates))
    assert table(daily.reconciliation(before_run="run-2")) == table(
        reconcile.revenue_reconciliation(before, rates))
    assert rows(daily.log(), "run_id", "month_start") == [
        ("run-1", d("2024-06-01")), ("run-2", d("2024-01-01")), ("run-2", d("2024-06-01"))]
    changed = daily.restated("run-2")
    assert rows(changed, "month_start", "delta_credit_usd") == [(d("2024-01-01"), usd("3"))]
    third = daily.run(after, rates, "run-3", "2024-07-20", "2024-07-20 05:00:00")
    assert third.expired == ["run-1"]
    with pytest.raises(LookupError):
        daily.reconciliation(run_id="run-1")


def test_staging_area_clears_what_was_staged(spark, frame, tmp_path):
    with staging_area(spark):
        inside = stage_table(frame("v long", (1,)), "inside")
        place = inside.inputFiles()[0].rpartition("/")[0].removeprefix("file://")
        assert os.path.isdir(place)
    assert not os.path.exists(place)
    outside = stage_table(frame("v long", (1,)), "outside")
    assert outside.count() == 1


# -- order -----------------------------------------------------------------------------------------
def test_next_version_reads_its_table_once(spark, frame):
    log = stage_table(frame("k string, n long, v long", *[("a", i, i * 10) for i in range(25)],
                            ("b", 3, 1), (None, 1, 7), (None, 2, 8), ("a", None, 99)), "log")
    out = with_next(log, ["k"], "n", "v", into="follow", is_last="last", width=4)
    found = {(r.k, r.n): (r.follow, r["last"]) for r in out.collect()}
    assert len(found) == 29
    for i in range(24):
        assert found["a", i] == ((i + 1) * 10, False)
    assert found["a", 24] == (99, False) and found["a", None] == (None, True)
    assert found["b", 3] == (None, True)
    assert found[None, 1] == (8, False) and found[None, 2] == (None, True)
    out.collect()
    plan = plan_of(out)
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_ordinals(spark, frame):
    values = [(i * 7919 % 1000,) for i in range(1000)]
    out = ordinals(frame("v long", *values).repartition(5), F.desc("v"), into="place")
    assert sorted((r.place, r.v) for r in out.collect()) == [(i + 1, 999 - i) for i in range(1000)]
    assert "Window" not in plan_of(out)
    assert ordinals(frame("v long").limit(0), F.col("v"), into="place").collect() == []


def test_restatement_log_takes_keys(build, frame):  # noqa: F811
    keys = frame("month_start date, legal_entity string", ("2024-02-01", "Inc"))
    log = restate.restatement_log(build(), "r", "2024-07-01 05:00:00", keys=keys)
    assert rows(log, "run_id", "month_start") == [("r", d("2024-02-01"))]


# -- declared checks -------------------------------------------------------------------------------
def test_check_report_reads_each_table_once(spark, frame):
    parents = stage_table(frame("id string, kind string", ("a", "x"), ("b", "y"), ("b", None),
                                (None, "z")), "parents")
    children = stage_table(frame("n long, id string, m long", (1, "a", 1), (1, "c", 1), (2, "c", 1),
                                 (2, None, 1), (2, None, 1)), "children")
    declared = {"p": checks.Checks(not_null=("id", "kind"), unique=("id",),
                                   accepted={"kind": ("x", "y")}),
                "c": checks.Checks(unique=("n",), parents={"id": ("p", "id")},
                                   combination=("n", "id"))}
    staged = []

    def stage(df, name):
        staged.append(plan_of(df).count("FileScan"))
        return stage_table(df, name)

    report = checks.check_report({"p": parents, "c": children}, declared, stage)
    assert staged == [1, 1]
    found = {(r.table_name, r.check_name, r.column_name): r.violations for r in report.collect()}
    assert found == {("p", "not_null", "id"): 1, ("p", "not_null", "kind"): 1,
                     ("p", "accepted_values", "kind"): 1, ("p", "unique", "id"): 1,
                     ("c", "unique", "n"): 2, ("c", "relationships", "id"): 1,
                     ("c", "unique_combination", "n, id"): 1}
    assert not {str(parents.inputFiles()[0]).split("/")[-2],
                str(children.inputFiles()[0]).split("/")[-2]} & set(
        re.findall(r"/((?:parents|children)-\w+)", plan_of(report)))
    empty = checks.check_report({"p": parents.limit(0), "c": children.limit(0)}, declared)
    assert {r.violations for r in empty.collect()} == {0} and empty.count() == 7


# -- versions at any moment ------------------------------------------------------------------------
@pytest.mark.parametrize("grain", ["month", "year"])
def test_as_of(frame, grain):
    rng = random.Random(7)
    day = lambda n: f"20{15 + n // 336:02d}-{n // 28 % 12 + 1:02d}-{n % 28 + 1:02d}"
    kept = [(rng.choice(["a", "b", "c", None]), rng.randrange(2000), i, rng.randrange(400))
            for i in range(80)]
    asked = [(i, rng.choice(["a", "b", "c", "d", None]),
              None if i % 50 == 0 else rng.randrange(2000)) for i in range(400)]
    versions = frame("k string, since date, n long, until date, label string", *[
        (k, day(s), n, day(min(s + length, 2300)), f"v{n}") for k, s, n, length in kept])
    probes = frame("i long, k string, day date, label string", *[
        (i, k, None if x is None else day(x), f"p{i}") for i, k, x in asked])
    out = as_of(probes.withColumnRenamed("label", "tag"), versions, ["k"], "day", "since",
                ["n", "label"], until="until", order="n", grain=grain)
    assert out.columns == ["i", "k", "day", "tag", "n", "label"]
    got = {r.i: (r.n, r.label, r.tag) for r in out.collect()}
    for i, k, x in asked:
        best = max(((s, n, s + length) for kk, s, n, length in kept
                    if k is not None and kk == k and x is not None and s <= x), default=None)
        n = best[1] if best and x < min(best[2], 2300) else None
        assert got[i] == (n, None if n is None else f"v{n}", f"p{i}")
    assert len(got) == 400
    plan = plan_of(out)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
