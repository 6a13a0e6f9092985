"""Headline queries over the driver tables; prints one JSON line.

Each query runs end to end from the raw tables into the noop sink. The time is
the median of ``BENCH_RUNS`` runs after a warm-up of the session; tables that a
query stores are written in every run. Medians and quantiles are the library's default
sketch; ``exact`` has the queries for which the exact ones differ. ``literal`` is the joined-grain
customer summary by way of the wide join, the plan that the weighted sums replace;
``weighted`` is ours, both over the same stored tables.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans import master
from ledgerloom.session import local_session
from workload.queries import Bank, forget, queries

HEADLINE = [
    "b_accounts",
    "s_accounts",
    "s_transactions",
    "ri_report",
    "fact_transactions",
    "kpi_branch_performance",
    "kpi_customer_branch",
    "kpi_high_value_txn",
    "customer_risk_score",
    "master_customer_summary_joined",
]


EXACT = ["s_accounts", "s_transactions", "kpi_high_value_txn"]


def timed(make, runs: int) -> float:
    seconds = []
    for _ in range(runs):
        forget()
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def literal_summary(t) -> DataFrame:
    return master.master_table(t).groupBy("customer_id").agg(
        F.sum("opening_balance"), F.sum("transaction_amount"), F.avg("opening_balance"), F.count("transaction_id")
    )


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(
        os.environ.get("BENCH_CPUS", "8"), app="ledgerloom-bench", **{"spark.ui.showConsoleProgress": "false"}
    )
    plans = queries(exact=False)
    plans["kpi_branch_performance"](spark, folder).collect()

    times = {name: timed(lambda plan=plans[name]: plan(spark, folder), runs) for name in HEADLINE}
    precise = queries(exact=True)
    exact = {name: timed(lambda plan=precise[name]: plan(spark, folder), runs) for name in EXACT}
    stored = Bank(spark, folder, exact=False).stored
    compared = {
        "weighted": timed(lambda: master.customer_summary(stored, master.JOINED), runs),
        "literal": timed(lambda: literal_summary(stored), runs),
    }
    result = {
        "metric": "headline queries, total of medians",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "exact": exact,
        "joined_summary": compared,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
