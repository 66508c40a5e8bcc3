import pytest
from conftest import d, rows, usd
from pyspark.sql import functions as F

from tallyspark.operators import quality, reconcile, restate
from tallyspark.sources.tables import replace_keys

INVOICE = ("invoice_id string, account_id string, invoice_date date, currency string, "
           "amount decimal(18,2), _loaded_at timestamp_ntz")
MEMO = ("invoice_id string, account_id string, issue_date date, system_entry_date date, "
        "currency string, amount decimal(18,2), _loaded_at timestamp_ntz")
PAYMENT = ("payment_id string, invoice_id string, account_id string, payment_date date, "
           "amount decimal(18,2), currency string, _loaded_at timestamp_ntz")
GL = ("invoice_id string, posting_date date, gl_account string, debit_credit string, "
      "amount decimal(18,2), currency string, je_type string, _loaded_at timestamp_ntz")
REVENUE, CASH = "4000-SUBSCRIPTION-REVENUE", "1000-CASH"


@pytest.fixture
def rates(frame):
    days = [f"2024-0{m}-{n:02d}" for m in (1, 2, 3) for n in range(1, 29)]
    return frame("rate_date date, quote_currency string, fx_rate decimal(18,6)",
                 *[(x, c, r) for x in days for c, r in (("USD", 1), ("EUR", "0.5"))])


@pytest.fixture
def build(frame):
    """Facts of two accounts, one of them without an entity; extra memos may be added."""
    def _build(*memos, payments=()):
        return reconcile.Facts(
            frame(INVOICE, ("I1", "A1", "2024-01-05", "EUR", 50, "2024-01-05"),
                  ("I2", "A1", "2024-02-05", "USD", 30, "2024-02-05"),
                  ("I3", "NOENT", "2024-01-07", "USD", 70, "2024-01-07")),
            frame(MEMO, ("I1", "A1", "2024-01-20", "2024-01-25", "EUR", 5, "2024-01-25"), *memos),
            frame(PAYMENT, ("P1", "I1", "A1", "2024-02-10", 50, "EUR", "2024-02-10"),
                  ("P2", "I1", "A1", "2024-02-10", 50, "EUR", "2024-02-10"),
                  ("P3", "I2", "A1", "2024-06-10", 30, "USD", "2024-06-10"), *payments),
            frame(GL, ("I1", "2024-01-05", REVENUE, "CREDIT", 50, "EUR", "AUTO_INVOICE", "2024-01-05"),
                  ("I1", "2024-01-05", REVENUE, "DEBIT", 1, "EUR", "MANUAL_ADJUSTMENT", "2024-01-05"),
                  ("I2", "2024-02-05", REVENUE, "CREDIT", 30, "USD", "AUTO_INVOICE", "2024-02-05"),
                  ("I1", "2024-03-01", CASH, "DEBIT", 9, "EUR", "AUTO_PAYMENT", "2024-03-01"),
                  ("GONE", "2024-01-09", REVENUE, "CREDIT", 8, "USD", "AUTO_INVOICE", "2024-01-09")),
            frame("account_id string, legal_entity string", ("A1", "Inc"), ("NOENT", None)))
    return _build


def table(df):
    return rows(df.select(*reconcile.KEY, *[F.round(m, 2).cast("string").alias(m)
                                            for m in restate.RESTATED]),
                *reconcile.KEY, *restate.RESTATED)


def test_full_reconciliation(build, rates):
    jan, feb, mar, jun = (d(f"2024-{m}-01") for m in ("01", "02", "03", "06"))
    zero = ("0.00",) * 5
    assert table(reconcile.revenue_reconciliation(build(), rates)) == [
        # Invoice of the account without entity and the ledger line without invoice: zeros.
        (jan, None, "0.00", *zero),
        (jan, "Inc", "100.00", "98.00", "10.00", "0.00", "-2.00", "88.00"),
        # The copy of the payment counts once.
        (feb, "Inc", "30.00", "30.00", "0.00", "100.00", "0.00", "30.00"),
        # A ledger line off the revenue account still lists its month.
        (mar, "Inc", "0.00", *zero),
        # No rate on that day: the key is listed, the amount is in no sum.
        (jun, "Inc", "0.00", *zero)]


def test_identity_check(build, rates, frame):
    full = reconcile.revenue_reconciliation(build(), rates)
    assert quality.billed_vs_recognized_gap(full).isEmpty()
    broken = full.withColumn("billed_usd", F.col("billed_usd") + 2)
    assert quality.billed_vs_recognized_gap(broken).count() == full.count()


def test_lookback_edge_and_late_memo(build):
    # The memo belongs to January, and entered the system exactly 60 days before the run.
    facts = build(("I2", "A1", "2024-01-28", "2024-05-02", "USD", 3, "2024-05-02"))
    keys = lambda as_of: rows(reconcile.affected_keys(facts, as_of), *reconcile.KEY)
    assert keys("2024-07-01") == [(d("2024-01-01"), "Inc"), (d("2024-06-01"), "Inc")]
    assert keys("2024-07-02") == [(d("2024-06-01"), "Inc")]
    assert keys("2030-01-01") == []
    # There is no upper bound: a run for a past date takes everything loaded since.
    assert (d("2024-06-01"), "Inc") in keys("2024-01-01")


def test_payments_since_keeps_only_recent_survivors(build):
    # A recent copy with a higher id does not survive; one with a lower id does.
    facts = build(payments=[("P9", "I1", "A1", "2024-02-10", 50, "EUR", "2024-05-01"),
                            ("P0", "I2", "A1", "2024-06-10", 30, "USD", "2024-07-01")])
    since = F.lit("2024-04-01").cast("timestamp_ntz")
    assert rows(facts.payments_since(since), "payment_id") == [("P0",)]
    plain = facts.payments.where(F.col("_loaded_at") >= since)
    assert rows(plain, "payment_id") == [("P0",)]


@pytest.mark.parametrize("as_of", ["2024-01-01", "2024-07-01", "2024-12-31"])
def test_incremental_equals_full(build, rates, as_of):
    before, after = build(), build(("I2", "A1", "2024-01-28", "2024-06-30", "USD", 3, "2024-06-30"))
    current = reconcile.revenue_reconciliation(before, rates)
    out = reconcile.revenue_reconciliation_incremental(current, after, rates, as_of)
    full = table(reconcile.revenue_reconciliation(after, rates))
    unchanged = table(current)
    assert table(out) == (unchanged if as_of == "2024-12-31" else full)


def test_restatement(build, rates):
    before = reconcile.revenue_reconciliation(build(), rates)
    facts = build(("I2", "A1", "2024-01-28", "2024-06-30", "USD", 3, "2024-06-30"))
    log = restate.restatement_log(facts, "run-7", "2024-07-01 05:00:00", "2024-07-01")
    assert rows(log, "run_id", "month_start") == [("run-7", d("2024-01-01")), ("run-7", d("2024-06-01"))]
    older = restate.restatement_log(facts, "run-6", "2024-06-30 05:00:00", "2024-01-01")
    newest = restate.restated_periods(log.unionByName(older))
    assert rows(newest, *log.columns) == rows(log, *log.columns)
    after = reconcile.revenue_reconciliation_incremental(before, facts, rates, "2024-07-01")
    diff = restate.restatement_diff(before, after, newest)
    got = rows(diff, "month_start", "legal_entity", "delta_credit_usd",
               "delta_recognized_net_of_credits_usd", "delta_billed_usd")
    # June is logged but did not change.
    assert got == [(d("2024-01-01"), "Inc", usd("3"), usd("-3"), usd("0"))]
    assert restate.restatement_diff(before, before).isEmpty()


def test_diff_of_appearing_key(build, rates):
    after = reconcile.revenue_reconciliation(build(), rates)
    before = after.where("month_start <> '2024-02-01'")
    row = restate.restatement_diff(before, after).first()
    assert (row.month_start, row.before_billed_usd, row.after_billed_usd) == (d("2024-02-01"), 0, 30)


def test_touched_keys_only(build, rates, frame):
    keys = frame("month_start date, legal_entity string", ("2024-02-01", "Inc"), ("2024-01-01", None))
    touched = reconcile.revenue_reconciliation_for(keys, build(), rates)
    assert [r[:2] for r in table(touched)] == [(d("2024-02-01"), "Inc")]
    full = reconcile.revenue_reconciliation(build(), rates)
    assert table(replace_keys(full, touched, reconcile.KEY)) == table(full)
