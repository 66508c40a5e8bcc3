import random
import re
from datetime import date, timedelta

import pytest
from conftest import d, rows, usd
from pyspark.sql import functions as F

from tallyspark.operators import arr, fx, quality, spines, versions, waterfall
from tallyspark.session import stage_table

CONTRACT = ("contract_version_sk string, contract_id string, version_number long, "
            "account_id string, effective_start_date date, effective_end_date date, "
            "arr_amount decimal(18,2), currency string, seats long, plan_tier string, "
            "amendment_type string, contract_version_recorded_at date, is_backdated boolean, "
            "co_termination_group string")


def version(contract, n, start, kind="new", amount="1200.00", currency="USD", end=None,
            account="A1"):
    return (f"{contract}-{n}", contract, n, account, start, end, amount, currency, 5, "Growth",
            kind, start, False, None)


@pytest.fixture
def accounts(frame):
    return frame("account_id string, region string, legal_entity string, segment string",
                 ("A1", "US", "Inc", "SMB"), ("A2", "EU", None, "Enterprise"))


@pytest.fixture
def axes(spark, frame):
    """Month ends of the first half of 2024, with rates."""
    daily = spines.date_spine_between(spark, d("2024-01-01"), d("2024-06-20"))
    rates = frame("rate_date date, quote_currency string, fx_rate decimal(18,6)",
                  ("2024-01-01", "USD", 1), ("2024-01-01", "EUR", "0.8"),
                  ("2024-03-15", "EUR", "0.5"), ("2024-01-01", "INR", 80))
    return spines.month_end_spine(daily), fx.fx_daily_filled(daily, rates)


def test_spines(frame, spark):
    a = frame("x date", ("2024-01-30",), (None,))
    b = frame("y date", ("2024-03-02",))
    daily = spines.date_spine_daily([(a, "x"), (b, "y")])
    assert daily.count() == 33
    assert rows(spines.month_end_spine(daily), "month_end_date") == [
        (d("2024-01-31"),), (d("2024-02-29"),)]


def test_fx_fill(spark, frame):
    daily = spines.date_spine_between(spark, d("2024-01-01"), d("2024-01-05"))
    rates = frame("rate_date date, quote_currency string, fx_rate decimal(18,6)",
                  ("2024-01-02", "EUR", "0.9"), ("2024-01-04", "EUR", "0.8"),
                  ("2024-01-01", "USD", 1))
    out = fx.fx_daily_filled(daily, rates)
    euro = rows(out.where("quote_currency = 'EUR'"), "rate_date", "fx_rate", "is_fx_rate_filled")
    assert [(str(r[1])[:3], r[2]) for r in euro] == [
        ("0.9", True), ("0.9", False), ("0.9", True), ("0.8", False), ("0.8", True)]
    assert out.where("quote_currency = 'INR' and fx_rate is null and is_fx_rate_filled").count() == 5


def test_to_usd_zero_and_missing_rate(frame):
    rates = frame("rate_date date, quote_currency string, fx_rate decimal(18,6)",
                  ("2024-01-01", "EUR", "0"), ("2024-01-01", "USD", "1"))
    facts = frame("day date, amount decimal(18,2), currency string", ("2024-01-01", 5, "EUR"),
                  ("2024-01-01", 5, "USD"), ("2024-01-02", 5, "USD"))
    out = fx.to_usd(facts, rates, "day")
    assert [r[0] for r in rows(out, "amount_usd")].count(None) == 2
    assert quality.unconverted_facts(out).count() == 2


def test_contract_validity(frame, accounts):
    contracts = frame(CONTRACT, version("C", 1, "2024-01-10"),
                      version("C", 2, "2024-03-05", None),
                      version("C", 3, "2024-05-01", "churn", 0, end="2024-05-01"),
                      version("D", 1, "2024-02-01", account="A2"),
                      version("D", 2, "2024-02-01", "upsell", account="A2"))
    out = versions.contract_versions(contracts, accounts)
    assert rows(out, "contract_id", "version_number", "effective_end_date_exclusive",
                "is_churn_version", "region") == [
        ("C", 1, d("2024-03-05"), False, "US"), ("C", 2, d("2024-05-01"), None, "US"),
        ("C", 3, d("2024-05-01"), True, "US"), ("D", 1, d("2024-02-01"), False, "EU"),
        ("D", 2, d("9999-12-31"), False, "EU")]


def contract_arr(frame, accounts, axes, *contract_rows, **options):
    validity = versions.contract_validity(frame(CONTRACT, *contract_rows))
    return arr.contract_arr_monthly(validity, accounts, *axes, **options)


def test_active_and_churned_contracts(frame, accounts, axes):
    out = contract_arr(
        frame, accounts, axes,
        version("ACTIVE", 1, "2024-03-31", amount="80.00", currency="EUR"),
        version("AT-END", 1, "2024-01-05"),
        version("AT-END", 2, "2024-02-29", "churn", 0, end="2024-02-29"),
        version("MID", 1, "2024-01-05"),
        version("MID", 2, "2024-02-10", "churn", 0, end="2024-02-10"),
        version("SAME", 1, "2024-04-02"),
        version("SAME", 2, "2024-04-20", "churn", 0, end="2024-04-20"))
    assert rows(out, "contract_id", "month_end_date", "arr_usd", "currency", "region") == [
        ("ACTIVE", d("2024-03-31"), usd("160.00"), "EUR", "US"),
        ("ACTIVE", d("2024-04-30"), usd("160.00"), "EUR", "US"),
        ("ACTIVE", d("2024-05-31"), usd("160.00"), "EUR", "US"),
        ("AT-END", d("2024-01-31"), usd("1200.00"), "USD", "US"),
        ("AT-END", d("2024-02-29"), usd("0.00"), None, "US"),
        ("MID", d("2024-01-31"), usd("1200.00"), "USD", "US"),
        ("MID", d("2024-02-29"), usd("0.00"), None, "US"),
        ("SAME", d("2024-04-30"), usd("0.00"), None, "US")]


def test_churn_in_the_open_month(frame, accounts, axes):
    churning = [version("C", 1, "2024-04-05"),
                version("C", 2, "2024-06-10", "churn", 0, end="2024-06-10")]
    assert contract_arr(frame, accounts, axes, *churning).count() == 0
    kept = contract_arr(frame, accounts, axes, *churning, open_churn="keep")
    assert rows(kept, "month_end_date", "arr_usd") == [
        (d("2024-04-30"), usd("1200.00")), (d("2024-05-31"), usd("1200.00"))]
    with pytest.raises(ValueError):
        contract_arr(frame, accounts, axes, *churning, open_churn="maybe")


def expected_months(log, months):
    """Month rows of one contract by trying every version at every month end."""
    log = sorted(log, key=lambda v: v[2])
    ends = [(log[i + 1][4] if i + 1 < len(log) else v[5]) or "9999-12-31"
            for i, v in enumerate(log)]
    first = min(v[4] for v in log)
    churns = [v[4] for v in log if v[10] == "churn"]
    if churns:
        later = [m for m in months if m >= max(churns)]
        last = later[0] if later else ""
    else:
        last = months[-1]
    out = []
    for m in months:
        if first <= m <= last:
            hits = [v for v, e in zip(log, ends, strict=True)
                    if v[10] != "churn" and v[4] <= m < e]
            out += [(log[0][1], m, v[2]) for v in hits] or [(log[0][1], m, None)]
    return out


def test_any_version_log_matches_trying_every_version(frame, accounts, axes):
    """Random logs: unordered and equal starts, churn in the middle, own ends, later versions."""
    rng = random.Random(3)
    months = [str(r[0]) for r in rows(axes[0], "month_end_date")]
    logs, expected = [], []
    for c in range(120):
        log = []
        ordered_starts = rng.random() < 0.5
        starts = [str(date(2023, 12, 1) + timedelta(days=rng.randint(0, 210)))
                  for _ in range(rng.randint(1, 5))]
        for n, start in enumerate(sorted(starts) if ordered_starts else starts, start=1):
            kind = rng.choice(["new", "renewal", "upsell", "churn"])
            end = start if kind == "churn" else rng.choice(
                [None, None, str(date.fromisoformat(start) + timedelta(days=rng.randint(0, 90)))])
            log.append(version(f"C{c:03d}", n, start, kind, 0 if kind == "churn" else 100, end=end))
        logs += log
        expected += expected_months(log, months)
    out = contract_arr(frame, accounts, axes, *logs).select(
        "contract_id", F.col("month_end_date").cast("string").alias("m"), "version_number")
    assert rows(out, "contract_id", "m", "version_number") == sorted(
        expected, key=lambda t: tuple("" if v is None else str(v) for v in t))


def bridge_of(contract_rows, frame, accounts, axes):
    monthly = contract_arr(frame, accounts, axes, *contract_rows)
    account = arr.account_arr_monthly(monthly)
    return arr.arr_bridge_monthly(monthly, account, axes[1])


def test_bridge_splits_real_and_fx(frame, accounts, axes):
    out = bridge_of([
        version("RATE", 1, "2024-02-01", amount="80.00", currency="EUR"),
        version("BOTH", 1, "2024-02-01", amount="80.00", currency="EUR"),
        version("BOTH", 2, "2024-03-10", "upsell", "160.00", "EUR"),
        version("SWAP", 1, "2024-02-01", amount="80.00", currency="EUR"),
        version("SWAP", 2, "2024-03-10", "currency_change", "100.00", "USD"),
    ], frame, accounts, axes).where("month_end_date = '2024-03-31'")
    assert rows(out, "contract_id", "real_component_usd", "fx_component_usd") == [
        ("BOTH", usd("100.00"), usd("120.00")),
        ("RATE", usd("0.00"), usd("60.00")),
        ("SWAP", usd("0.00"), usd("0.00"))]


def test_movement_of_returning_account_and_second_contract(frame, accounts, axes):
    bridge = bridge_of([
        version("FIRST", 1, "2024-01-05"),
        version("FIRST", 2, "2024-02-10", "churn", 0, end="2024-02-10"),
        version("BACK", 1, "2024-04-05"),
        version("SECOND", 1, "2024-05-05", amount="10.00"),
    ], frame, accounts, axes)
    movements = waterfall.arr_movements(bridge)
    assert rows(movements, "contract_id", "month_end_date", "movement_type") == [
        ("BACK", d("2024-04-30"), "reactivation"), ("BACK", d("2024-05-31"), "no_change"),
        ("FIRST", d("2024-01-31"), "new"), ("FIRST", d("2024-02-29"), "churn"),
        ("SECOND", d("2024-05-31"), "expansion")]
    account = waterfall.waterfall_account(movements)
    portfolio = waterfall.waterfall_portfolio(account)
    direct = waterfall.waterfall_portfolio(waterfall.movement_measures(movements))
    assert rows(portfolio, *portfolio.columns) == rows(direct, *portfolio.columns)
    assert rows(portfolio, "month_end_date", "total_arr_usd", "prior_total_arr_usd") == [
        (d("2024-01-31"), usd("1200.00"), None),
        (d("2024-02-29"), usd("0.00"), usd("1200.00")),
        (d("2024-04-30"), usd("1200.00"), usd("0.00")),
        (d("2024-05-31"), usd("1210.00"), usd("1200.00"))]
    assert quality.decomposition_gap(bridge).isEmpty()
    assert quality.account_waterfall_gap(account).isEmpty()
    assert quality.portfolio_waterfall_gap(portfolio).isEmpty()


@pytest.mark.parametrize("seq, prior_account, ever, usd_now, prior, real, expected", [
    (1, 0, False, 10, 0, 10, "new"), (1, 0, True, 10, 0, 10, "reactivation"),
    (1, 5, True, 10, 0, 10, "expansion"), (1, 5, False, 0, 0, 0, "expansion"),
    (2, 5, True, 0, 5, -5, "churn"), (2, 5, True, 9, 5, 4, "expansion"),
    (2, 5, True, 3, 5, -2, "contraction"), (2, 5, True, 6, 5, 0, "no_change"),
    (2, 5, True, 0, 0, 0, "no_change")])
def test_classification(frame, seq, prior_account, ever, usd_now, prior, real, expected):
    df = frame("contract_month_seq int, prior_account_arr_usd decimal(18,2), "
               "account_ever_had_arr_before boolean, arr_usd decimal(18,2), "
               "prior_arr_usd_filled decimal(18,2), real_component_usd decimal(18,2)",
               (seq, prior_account, ever, usd_now, prior, real))
    assert df.select(waterfall.classify_movement().alias("m")).first().m == expected


def test_customer_versions(frame):
    df = frame("customer_master_sk string, account_id string, customer_master_version long, "
               "billing_contact_name string, billing_contact_email string, tax_id string, "
               "address_line1 string, city string, region string, legal_entity string, "
               "updated_at date",
               ("s1", "A", 1, "n", "e", "t", "a", "c", "US", "Inc", "2024-01-01"),
               ("s2", "A", 2, "n2", "e", "t", "a", "c", "US", "Inc", "2024-02-01"),
               ("s3", "B", 1, "m", "e", "t", "a", "c", "US", "Inc", "2024-01-15"))
    out = versions.customer_master_versions(df)
    assert rows(out, "customer_master_sk", "effective_end_date_exclusive",
                "is_current_version") == [
        ("s1", d("2024-02-01"), False), ("s2", d("9999-12-31"), True),
        ("s3", d("9999-12-31"), True)]
    assert rows(versions.dim_customer(out), "account_id", "billing_contact_name") == [
        ("A", "n2"), ("B", "m")]


def test_months_of_overlapping_validities(spark, frame):
    """Random validities, tidy or not, over more months than one number has bits."""
    rng = random.Random(5)
    ends = [(date(2015 + m // 12, m % 12 + 1, 1), m) for m in range(100)]
    spine = frame("month_end_date date", *[
        ((date(x.year + x.month // 12, x.month % 12 + 1, 1) - timedelta(days=1)).isoformat(),)
        for x, _ in ends])
    accounts = frame("account_id string, region string, legal_entity string, segment string",
                     ("A", "US", "Inc", "SMB"), ("B", "EU", "BV", "SMB"))
    versions, expected = [], []
    for c in range(40):
        count = rng.randint(1, 5)
        drawn = []
        for v in range(count):
            start = date(2014, 6, 1) + timedelta(days=rng.randint(0, 3200))
            end = start + timedelta(days=rng.randint(-200, 1500))
            churn = v == count - 1 and rng.random() < 0.4 or rng.random() < 0.1
            drawn.append((start, end, churn, v == count - 1))
        versions += [(f"C{c}", v, "A" if c % 3 or v else "B", s.isoformat(), e.isoformat(), 100 + v,
                      churn, last) for v, (s, e, churn, last) in enumerate(drawn)]
        owners = {"A" if c % 3 or v else "B" for v in range(count)}
        for owner in owners:
            mine = [x for v, x in enumerate(drawn) if owner == ("A" if c % 3 or v else "B")]
            number = lambda x: (x.year - 2015) * 12 + x.month - 1
            low = max(0, number(min(s for s, *_ in mine)))
            churns = [s for s, _, churn, _ in mine if churn]
            high = max(0, number(max(churns))) if churns else 99
            if high > 99:
                continue
            for m in range(low, high + 1):
                on = [v for v, (s, e, churn, _) in enumerate(drawn)
                      if not churn and number(s) <= m < number(e)]
                off = any((min(number(s), number(e)) <= m) if last else number(s) <= m < number(e)
                          for s, e, _, last in drawn)
                expected += [(f"C{c}", owner, m, v) for v in on]
                expected += [(f"C{c}", owner, m, None)] if off and not on else []
    table = frame(
        "contract_id string, version_number long, account_id string, effective_start_date date, "
        "effective_end_date_exclusive date, arr_amount decimal(18,2), is_churn_version boolean, "
        "is_last_version boolean", *versions).selectExpr(
        "*", "'USD' AS currency", "1L AS seats", "'Starter' AS plan_tier",
        "'new' AS amendment_type", "false AS is_backdated", "'' AS co_termination_group",
        "'US' AS region", "'Inc' AS legal_entity")
    table = stage_table(table, "versions")
    spans = stage_table(arr.contract_spans(table, accounts, spine), "spans")
    out = arr._expand(table, spans)
    month = F.months_between(F.trunc("month_end_date", "MM"), F.lit("2015-01-01")).cast("int")
    found = [tuple(r) for r in out.select(
        "contract_id", "account_id", month, "version_number").collect()]
    key = lambda r: (*r[:3], -1 if r[3] is None else r[3])
    assert sorted(found, key=key) == sorted(expected, key=key) and len(expected) > 2000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet .*?/versions-", plan)) == 1
