"""Times the headline queries and prints one JSON line.

Tables are landed once, the shared intermediates staged once, the marts written once and the facts
laid out by month once (timed as ``land``, ``stage``, ``marts`` and ``facts``, and part of the sum);
each query is then run to completion, warm, and the median of the repeats is taken. ``spread`` gives
the fastest and the slowest repeat.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tallyspark.operators import arr, dashboard, versions
from tallyspark.plans.pipeline import RevenuePlan
from tallyspark.session import build_session
from tallyspark.sources.star import COST_RUN_DATE, RUN_DATE, StarTables

# Each query continues from models staged before it, as the marts of a pipeline run do; the last
# one goes from the landed tables to the headline figures in one piece.
QUERIES = {
    "contract_validity": lambda p: versions.contract_validity(p.contracts),
    "contract_arr_monthly": lambda p: arr.contract_arr_monthly(
        p.contract_validity, p.accounts, p.month_ends, p.fx, spans=p.contract_spans),
    "account_arr_monthly": lambda p: p.account_arr,
    "arr_bridge_monthly": lambda p: p.bridge,
    "arr_movements": lambda p: p.movements,
    "arr_waterfall_account": lambda p: p.account_waterfall,
    "arr_waterfall_portfolio": lambda p: p.portfolio_waterfall,
    "arr_by_segment": lambda p: dashboard.arr_by_segment(p.account_mart, p.latest_month),
    "payments_dedupe": lambda p: p.payments,
    "revenue_reconciliation": lambda p: p.reconciliation,
    "revenue_reconciliation_touched": lambda p: p.reconciliation_touched(RUN_DATE),
    "dim_customer": lambda p: p.dim_customer,
    "cost_by_layer_daily": lambda p: p.cost_by_layer(COST_RUN_DATE),
    "landed_to_portfolio": lambda p: RevenuePlan(p.landed).portfolio_waterfall,
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(f"local[{cpus}]", int(cpus), "16g")
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    landed = dict(StarTables(spark, folder).land())
    timings = {"land": round(time.perf_counter() - start, 3)}
    start = time.perf_counter()
    plan = RevenuePlan(landed)
    plan.contract_arr  # noqa: B018 - builds and stages everything before it as well
    timings["stage"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    plan.account_mart, plan.latest_month  # noqa: B018
    timings["marts"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    plan.facts  # noqa: B018
    timings["facts"] = round(time.perf_counter() - start, 3)
    spread = {}
    for name, build in QUERIES.items():
        runs = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            build(plan).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(runs[1:]), 3)
        spread[name] = [round(min(runs[1:]), 3), round(max(runs[1:]), 3)]
    print(json.dumps({
        "metric": "sum of landing, staging, marts, facts and warm median query times",
        "value": round(sum(timings.values()), 3),
        "unit": "sec", "queries": timings, "spread": spread, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
