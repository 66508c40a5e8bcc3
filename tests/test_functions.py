import hashlib
import random

import pytest
from conftest import d, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspark.functions import masking, ordered, scalar


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_surrogate_key_tells_null_from_empty(spark, frame):
    df = frame("a string, b long", ("x", 1), (None, 1), ("", 1))
    keys = [r.k for r in df.select(scalar.surrogate_key("a", "b").alias("k")).collect()]
    assert keys[0] == hashlib.md5(b"x-1").hexdigest()
    assert len(set(keys)) == 3 and None not in keys


def test_divisions(spark):
    lit = F.lit
    assert one(spark, scalar.guarded_divide(lit(1), lit(0))) is None
    assert one(spark, scalar.div0(lit(5), lit(0))) == 0
    assert one(spark, scalar.div0(lit(5).cast("int"), lit(None).cast("int"))) is None
    assert one(spark, scalar.percent_change(lit(110), lit(100))) == 10
    assert one(spark, scalar.percent_change(lit(110), lit(0))) == 0
    assert one(spark, scalar.percent_change(lit(110), lit(None).cast("int"))) is None


def test_dates(spark):
    day = F.lit("2024-02-10").cast("date")
    assert one(spark, scalar.month_start(day)) == d("2024-02-01")
    assert one(spark, scalar.month_end(day)) == d("2024-02-29")
    assert one(spark, scalar.open_ended(F.lit(None).cast("date"))) == d("9999-12-31")
    assert one(spark, scalar.as_of_date("2024-05-01")) == d("2024-05-01")
    assert str(one(spark, scalar.days_before(scalar.as_of_timestamp("2024-03-01"), 60))) \
        == "2024-01-01 00:00:00"


def test_fill(frame):
    df = frame("k string, t long, v long", ("a", 1, None), ("a", 2, 5), ("a", 3, None),
               ("a", 4, 7), ("b", 1, None))
    out = df.select("k", "t", scalar.fill_forward("v", ["k"], "t").alias("f"),
                    scalar.fill_backward("v", ["k"], "t").alias("b"))
    assert rows(out, "k", "t", "f", "b") == [
        ("a", 1, None, 5), ("a", 2, 5, 5), ("a", 3, 5, 7), ("a", 4, 7, 7), ("b", 1, None, None)]


def test_ids_and_tags(spark):
    assert one(spark, scalar.padded_id("INV", F.lit(42), 7)) == "INV-0000042"
    assert one(spark, scalar.padded_id("INV", F.lit(123456789), 7)) == "INV-123456789"
    assert one(spark, scalar.query_tag("p", "prod", "i1", "s", "m")) == (
        '{"app":"dbt","project":"p","target":"prod","invocation_id":"i1","schema":"s","model":"m"}')
    assert "model" not in one(spark, scalar.query_tag("p", "prod", "i1"))


@pytest.mark.parametrize("role, email, other", [
    ("RL_ADMIN", "jo@a.com", "x"), ("RL_TRANSFORMER", "jo@a.com", "x"),
    ("RL_REVENUE_CONTROLLER", "jo@a.com", "x"), ("RL_FINANCE_ANALYST", "j***@a.com", "***MASKED***"),
    ("RL_BI_READER", "j***@a.com", "***MASKED***"), ("ANY_NEW_ROLE", "j***@a.com", "***MASKED***")])
def test_masks_by_role(frame, role, email, other):
    df = frame("e string, t string", ("jo@a.com", "x"), (None, None))
    out = df.select(masking.mask_email("e", role).alias("e"),
                    masking.mask_tax_id("t", role).alias("t"))
    assert rows(out, "e", "t") == [(None, None), (email, other)]


def test_mask_email_odd_texts(frame):
    df = frame("e string", ("nosign",), ("a@b@c.org",), ("",))
    shown = df.select("e", masking.mask_email("e", "RL_BI_READER").alias("m"))
    assert dict(rows(shown, "e", "m")) == {
        "nosign": "n***@nosign", "a@b@c.org": "a***@c.org", "": "***@"}
    strict = df.select("e", masking.mask_email("e", "RL_BI_READER", strict=True).alias("m"))
    assert dict(rows(strict, "e", "m"))["nosign"] == "***MASKED***"


@pytest.fixture
def shuffled(spark):
    """Keys of very different size, with gaps in the order numbers."""
    rng = random.Random(7)
    data = []
    for key, size in (("hot", 400), ("warm", 30), ("one", 1)):
        for n in rng.sample(range(size * 3), size):
            data.append((key, n, rng.randint(0, 5) or None))
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, n long, v long")


def test_with_next_equals_lead(shuffled):
    w = Window.partitionBy("k").orderBy("n")
    plain = shuffled.select("*", F.lead("v").over(w).alias("nv"),
                            F.lead(F.lit(1)).over(w).isNull().alias("last"))
    cut = ordered.with_next(shuffled, ["k"], "n", "v", "nv", is_last="last", width=16)
    assert rows(cut, "k", "n", "v", "nv", "last") == rows(plain, "k", "n", "v", "nv", "last")


def test_with_next_sorts_null_last(frame):
    df = frame("k string, n long, v long", ("a", None, 9), ("a", 1, 5))
    out = ordered.with_next(df, ["k"], "n", "v", "nv", is_last="last")
    assert rows(out, "n", "nv", "last") == [(None, None, True), (1, 9, False)]


def test_running_count_equals_window(shuffled):
    w = Window.partitionBy("k").orderBy("n")
    hit = F.col("n") % 3 == 0
    plain = shuffled.withColumn("c", F.sum(hit.cast("long")).over(w))
    cut = ordered.with_running_count(shuffled, ["k"], "n", hit, "c", width=16)
    assert rows(cut, "k", "n", "c") == rows(plain, "k", "n", "c")


@pytest.mark.parametrize("hot_rows", [10, 1000])
def test_rank_equals_window(shuffled, hot_rows):
    df = shuffled.withColumn("decade", F.floor(F.col("n") / 10))
    w = Window.partitionBy("k")
    plain = df.select("k", "n", F.row_number().over(w.orderBy("n")).cast("long").alias("r"),
                      F.count("*").over(w).alias("t"))
    cut = ordered.with_rank(df, ["k"], ["decade", "n"], "r", "t", hot_rows=hot_rows)
    assert rows(cut.withColumn("r", F.col("r").cast("long")), "k", "n", "r", "t") \
        == rows(plain, "k", "n", "r", "t")
