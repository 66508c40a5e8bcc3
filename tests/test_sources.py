import json
import os
import re

import pytest
from conftest import d, rows, usd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas as S
from tallyspark.operators.staging import dedupe_payments, stg_payments
from tallyspark.sources import landing, snapshots, tables
from tallyspark.streaming import landing as streams

MEMO_FILE = '''credit_memo_id,invoice_id,account_id,issue_date,system_entry_date,currency,amount,reason
CM-1,INV-1,ACC-1,2024-01-02,2024-02-03,USD,10.50,goodwill
CM-2,"INV,2",NULL,2024-01-02,,EUR,null,""
CM-3,"say ""hi""",ACC-3,2024-01-05,2024-01-05,"USD",7,billing_error
'''


def test_landing_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(MEMO_FILE)
    df = landing.read_landing_csv(spark, str(tmp_path), S.LANDED["credit_memos"])
    assert df.schema == S.LANDED["credit_memos"]
    assert rows(df, *df.columns) == [
        ("CM-1", "INV-1", "ACC-1", d("2024-01-02"), d("2024-02-03"), "USD", usd("10.50"), "goodwill"),
        ("CM-2", "INV,2", None, d("2024-01-02"), None, "EUR", None, None),
        ("CM-3", 'say "hi"', "ACC-3", d("2024-01-05"), d("2024-01-05"), "USD", usd("7.00"),
         "billing_error")]


def test_landing_csv_rejects_malformed_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text(MEMO_FILE.replace("10.50", "ten"))
    df = landing.read_landing_csv(spark, str(tmp_path), S.LANDED["credit_memos"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.collect()


def test_landing_csv_timestamps_and_whole_numbers(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "query_id,warehouse_name,query_tag,start_time,total_elapsed_time\n"
        'q1,W,"{""a"": 1}",2024-01-02 03:04:05,12.0\n')
    row = landing.read_landing_csv(
        spark, str(tmp_path), S.SIDE_INPUTS["query_history"]).first()
    assert (row.query_tag, str(row.start_time), row.total_elapsed_time) == (
        '{"a": 1}', "2024-01-02 03:04:05", 12)


def test_landing_json(spark, tmp_path):
    records = [{"account_id": "A1", "version": 1, "updated_at": "2024-01-01"},
               {"account_id": "A2", "version": 2, "city": "Pune"}]
    (tmp_path / "array").mkdir()
    (tmp_path / "array" / "a.json").write_text(json.dumps(records, indent=1))
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text("\n".join(map(json.dumps, records)))
    for folder, outer in (("array", True), ("lines", False)):
        df = landing.read_landing_json(spark, str(tmp_path / folder), S.LANDED["customer_master"],
                                       outer_array=outer)
        assert rows(df, "account_id", "version", "city", "updated_at") == [
            ("A1", 1, None, d("2024-01-01")), ("A2", 2, "Pune", None)]


def test_staged_files_and_feed(spark, tmp_path):
    assert not landing.feed_arrived(spark, str(tmp_path), "2024-01-02", S.BILLING_FEED)
    day = tmp_path / "2024-01-02" / "payments"
    day.mkdir(parents=True)
    (day / "payments.csv").write_text("payment_id\nP1\n")
    assert landing.feed_arrived(spark, str(tmp_path), "2024-01-02", S.BILLING_FEED)
    assert not landing.feed_arrived(spark, str(tmp_path), "2024-01-03", S.BILLING_FEED)
    assert not landing.feed_arrived(spark, str(tmp_path), "2024-01-02", ["invoices"])
    staged = landing.list_staged(spark, str(tmp_path))
    assert [r.size_bytes for r in staged.collect()] == [14]
    assert landing.not_yet_loaded(staged, staged).isEmpty()
    assert landing.not_yet_loaded(staged, staged.limit(0)).count() == 1


@pytest.fixture
def invoices(frame):
    return frame("invoice_id string, contract_id string, account_id string, invoice_date date, "
                 "currency string, amount decimal(18,2)",
                 ("I1", "C1", "A1", "2024-01-02", "USD", 10), ("I2", "C1", "A1", "2024-01-03", "USD", 20))


def test_daily_slices(frame, invoices, spark, tmp_path):
    lines = frame("invoice_line_id string, invoice_id string", ("L1", "I1"), ("L2", "I2"))
    day = landing.daily_slice(invoices, "invoice_date", "2024-01-02")
    assert rows(day, "invoice_id") == [("I1",)]
    assert rows(landing.daily_slice_child(lines, day, "invoice_id"), "invoice_line_id") == [("L1",)]
    stamped = frame("t timestamp", ("2024-01-02 23:59:59",), ("2024-01-03 00:00:00",))
    assert landing.daily_slice(stamped, "t", "2024-01-02").count() == 1
    all_tables = {"invoices": invoices, "invoice_line_items": lines}
    assert tables.write_daily(all_tables, "2024-01-09", str(tmp_path)) == []
    assert tables.write_daily(all_tables, "2024-01-03", str(tmp_path)) == [
        "invoices", "invoice_line_items"]
    back = landing.read_landing_csv(spark, f"{tmp_path}/2024-01-03/invoices", S.LANDED["invoices"])
    assert rows(back, "invoice_id", "amount") == [("I2", usd("20.00"))]


def test_insert_if_absent(spark, frame, invoices, tmp_path):
    path = str(tmp_path / "t")
    tables.insert_if_absent(spark, path, invoices, ["invoice_id"], F.lit("2024-01-05"))
    first = rows(spark.read.parquet(path), "invoice_id", "amount", "_loaded_at")
    tables.insert_if_absent(spark, path, invoices, ["invoice_id"])
    assert rows(spark.read.parquet(path), "invoice_id", "amount", "_loaded_at") == first
    changed = frame("invoice_id string, contract_id string, account_id string, invoice_date date, "
                    "currency string, amount decimal(18,2)",
                    ("I1", "C1", "A1", "2024-01-02", "USD", 99),
                    ("I3", "C1", "A1", "2024-01-04", "USD", 1),
                    ("I3", "C1", "A1", "2024-01-04", "USD", 2),
                    (None, "C1", "A1", "2024-01-04", "USD", 3))
    for _ in range(2):
        tables.insert_if_absent(spark, path, changed, ["invoice_id"])
    got = [(r[0], int(r[1])) for r in rows(spark.read.parquet(path), "invoice_id", "amount")]
    # Known keys keep their value; copies within one batch both land; a NULL key lands every time.
    assert got == [(None, 3), (None, 3), ("I1", 10), ("I2", 20), ("I3", 1), ("I3", 2)]


def test_insert_if_absent_partitioned(spark, invoices, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        tables.insert_if_absent(spark, path, invoices, ["invoice_id"],
                                partition_by=["invoice_date"])
    assert spark.read.parquet(path).count() == 2
    assert (tmp_path / "t" / "invoice_date=2024-01-02").is_dir()


def test_replace_keys_keeps_null_keys(frame):
    ddl = "m date, e string, v long"
    current = frame(ddl, ("2024-01-01", "X", 1), ("2024-02-01", "X", 2), ("2024-01-01", None, 3))
    fresh = frame(ddl, ("2024-01-01", "X", 10), ("2024-03-01", "Y", 4))
    assert rows(tables.replace_keys(current, fresh, ["m", "e"]), "v") == [(10,), (2,), (3,), (4,)]


def test_mart_log_and_partitions(spark, frame, tmp_path):
    df = frame("p string, v long", ("a", 1), ("b", 2))
    mart, log = str(tmp_path / "mart"), str(tmp_path / "log")
    for _ in range(2):
        tables.write_mart(df, mart, ["p"])
        tables.append_log(df, log)
    assert spark.read.parquet(mart).count() == 2 and spark.read.parquet(log).count() == 4
    tables.overwrite_partitions(frame("p string, v long", ("b", 20)), mart, ["p"])
    assert rows(spark.read.parquet(mart), "p", "v") == [("a", 1), ("b", 20)]
    assert tables.empty_like(spark, S.LANDED["invoices"]).schema == S.LANDED["invoices"]


def test_snapshots(spark, frame, tmp_path):
    root = str(tmp_path / "s")
    with pytest.raises(LookupError):
        snapshots.snapshot_read(spark, root)
    for run, value, at in (("r1", 1, "2024-01-01 00:00:00"), ("r2", 2, "2024-01-02 00:00:00")):
        snapshots.snapshot_write(frame("v long", (value,)), root, run, at)
    read = lambda **k: snapshots.snapshot_read(spark, root, **k).first().v
    assert read() == 2 and read(before="2024-01-02 00:00:00") == 1 and read(run_id="r1") == 1
    assert read(before_run="r2") == 1
    with pytest.raises(LookupError):
        read(before="2024-01-01 00:00:00")


PAYMENT = ("payment_id string, invoice_id string, account_id string, payment_date date, "
           "amount decimal(18,2), currency string, _loaded_at timestamp_ntz")


def payment(pid, day="2024-01-05", amount=10, currency="USD", loaded="2024-01-05"):
    return (pid, "I1", "A1", day, amount, currency, loaded)


def test_payment_dedupe(frame):
    df = frame(PAYMENT, payment("P2"), payment("P1", loaded="2024-01-09"), payment("P3", amount=5),
               payment("P4", day="2024-01-06"), payment("P6", currency=None),
               payment("P5", currency=None), payment(None, amount=7), payment("P9", amount=7))
    assert rows(stg_payments(df), "payment_id") == [("P1",), ("P3",), ("P4",), ("P5",), ("P9",)]
    kept = dedupe_payments(df).where("payment_id = 'P1'").first()
    assert str(kept._loaded_at) == "2024-01-09 00:00:00"


def test_stream_landing_takes_each_key_once(spark, tmp_path):
    header, one, two, three = MEMO_FILE.strip().split("\n")
    folder = tmp_path / "in"
    folder.mkdir()

    def run():
        streams.stream_landing(
            spark, str(folder), S.LANDED["credit_memos"], ["credit_memo_id"],
            str(tmp_path / "t"), str(tmp_path / "cp"), max_files=1).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "t")), "credit_memo_id", "amount")

    (folder / "a.csv").write_text("\n".join([header, one]))
    assert run() == [("CM-1", usd("10.50"))]
    (folder / "b.csv").write_text("\n".join([header, one.replace("10.50", "99"), three]))
    (folder / "c.csv").write_text("\n".join([header, two]))
    assert run() == [("CM-1", usd("10.50")), ("CM-2", None), ("CM-3", usd("7.00"))]
    assert len(run()) == 3


def test_stream_payments_staging_lower_id_arrives_second(spark, frame, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "staged")

    def arrive(*payments):
        tables.append_log(frame(PAYMENT, *payments).coalesce(1), raw)
        streams.stream_payments_staging(spark, raw, target, str(tmp_path / "cp"),
                                        max_files=1).awaitTermination()
        return rows(spark.read.parquet(target), "payment_id")

    assert arrive(payment("P2"), payment("P7", day="2024-01-06")) == [("P2",), ("P7",)]
    assert arrive(payment("P1"), payment("P8", day=None)) == [("P1",), ("P7",), ("P8",)]
    full = dedupe_payments(spark.read.parquet(raw))
    assert rows(full, "payment_id") == rows(spark.read.parquet(target), "payment_id")


def test_stream_landing_does_not_depend_on_batches(spark, tmp_path):
    header, one, two, three = MEMO_FILE.strip().split("\n")
    folder = tmp_path / "in"
    folder.mkdir()
    for i, lines in enumerate(([one, one], [one.replace("10.50", "99"), two], [two, three])):
        (folder / f"{9 - i}.csv").write_text("\n".join([header, *lines]))
        os.utime(folder / f"{9 - i}.csv", (1_700_000_000 + i, 1_700_000_000 + i))
    found = []
    for files in (None, 2, 1):
        target = str(tmp_path / f"t{files}")
        streams.stream_landing(
            spark, str(folder), S.LANDED["credit_memos"], ["credit_memo_id"], target,
            str(tmp_path / f"cp{files}"), max_files=files).awaitTermination()
        found.append(rows(spark.read.parquet(target), "credit_memo_id", "amount"))
    assert found[0] == [("CM-1", usd("10.50")), ("CM-1", usd("10.50")), ("CM-2", None),
                        ("CM-3", usd("7.00"))]
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("change", [lambda r: r.rpartition(",")[0], lambda r: r + ",more"])
def test_rows_of_the_wrong_length_are_errors(spark, tmp_path, change):
    header, one, *_ = MEMO_FILE.strip().split("\n")
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([header, one, change(one)]))
    memos = landing.read_landing_csv(spark, str(folder), S.LANDED["credit_memos"])
    for df in (memos, memos.select("credit_memo_id")):
        with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed|FAILED_READ_FILE"):
            df.collect()
    with pytest.raises(Exception):
        streams.stream_landing(
            spark, str(folder), S.LANDED["credit_memos"], ["credit_memo_id"],
            str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination()


def test_fractions_are_rounded_and_quoted_breaks_read(spark, tmp_path):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("t", T.StringType())])
    (tmp_path / "a.csv").write_text('n,t\n1.5," two\nlines ""q"" "\n-2.5,x\n1.4,y\n')
    out = landing.read_landing_csv(spark, str(tmp_path), schema, multi_line=True)
    assert rows(out, "n", "t") == [(-3, "x"), (1, "y"), (2, ' two\nlines "q" ')]


def test_insert_searches_the_range_of_the_batch(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    ddl = "k string, day date, v long"
    old = frame(ddl, ("a", "2024-01-01", 1), ("b", "2024-01-02", 1), ("c", None, 1))
    tables.insert_if_absent(spark, path, old, ["k"], partition_by=["day"])
    new = frame(ddl, ("b", "2024-01-02", 9), ("c", None, 9), ("d", "2024-01-03", 9))
    near = tables.within_range(spark.read.parquet(path), new, ["day"])
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*day#\d+ >= ", plan)
    tables.insert_if_absent(spark, path, new, ["k"], partition_by=["day"], prune=["day"])
    assert rows(spark.read.parquet(path), "k", "v") == [("a", 1), ("b", 1), ("c", 1), ("d", 9)]
