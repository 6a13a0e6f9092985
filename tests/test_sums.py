"""Sums of doubles are the same on any partitioning, and rounded once."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import sums
from ledgerloom.plans import star

COLUMNS = {"t": sums.TOTAL, "a": sums.MEAN, "n": sums.ROWS, "k": sums.known("x")}


def exact(values):
    """The exact sum, rounded once, by the rules of doubles."""
    known = [v for v in values if v is not None]
    if not known:
        return None
    special = [v for v in known if not math.isfinite(v)]
    if special:
        return sum(special)
    total = sum(map(Fraction, known), Fraction(0))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def wide(n, seed):
    draw = random.Random(seed)
    return [draw.choice([-1, 1]) * draw.random() * 10.0 ** draw.uniform(-300, 300) for _ in range(n)]


CASES = {
    "tenths": [0.1] * 1000,
    "money": [random.Random(i).randint(1, 10**8) / 100 for i in range(2000)],
    "cancelling": [1e100, 1.0, -1e100, 1e-30, 2.0**53, 1.0, -(2.0**53)],
    "wide": wide(500, 1),
    "wide and back": wide(200, 2) + [-x for x in wide(200, 2)] + [0.1, 0.2],
    "smallest": [5e-324, 5e-324, -5e-324, 2.5e-308, 1e-320],
    "largest": [1.7e308, 1.7e308, -1.7e308, -1.7e308, 3.0],
    "too large": [1.7e308, 1.7e308],
    "powers": [2.0**e for e in range(-60, 60)] + [-(2.0**e) * (1 - 2**-53) for e in range(-60, 60)],
    "holes": [None, 1.5, None],
    "nothing": [None, None],
    "zeros": [0.0, -0.0],
    "infinite": [1.0, math.inf, 2.0],
    "both infinite": [math.inf, -math.inf],
}


@pytest.mark.parametrize("case", CASES)
def test_sums_are_exact_and_rounded_once(spark, case):
    values, want = CASES[case], exact(CASES[case])
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    for parts in (1, 3, 7):
        got = sums.grouped(rows.repartition(parts), [], "x", COLUMNS).first()
        assert got.t == want or math.isnan(got.t) and math.isnan(want)
        assert (got.n, got.k) == (len(values), sum(v is not None for v in values))
        assert got.a is None if not got.k else got.a == want / got.k or math.isnan(got.a)


def test_groups_on_any_partitioning(spark):
    draw = random.Random(3)
    rows = [(draw.randint(0, 20), draw.uniform(-1e6, 1e6) * 10.0 ** draw.randint(-9, 9)) for _ in range(5000)]
    want = {g: exact([x for k, x in rows if k == g]) for g in {k for k, _ in rows}}
    results = set()
    for seed in range(4):
        draw.shuffle(rows)
        frame = spark.createDataFrame(rows, "g int, x double").repartition(1 + 3 * seed)
        got = sums.grouped(frame, ["g"], "x", {"t": sums.TOTAL})
        results.add(tuple(sorted((r.g, r.t) for r in got.collect())))
    assert results == {tuple(sorted(want.items()))}


def test_partial_sums_may_be_added_up_again(spark):
    rows = [(i % 50, i % 3, x) for i, x in enumerate(wide(3000, 4))]
    frame = spark.createDataFrame(rows, "g int, h int, x double")
    partial = sums.units(frame, ["g", "h"], "x", COLUMNS)
    got = {r.h: (r.t, r.n) for r in sums.finished(partial, ["h"], COLUMNS).collect()}
    assert got == {h: (exact([x for _, k, x in rows if k == h]), 1000) for h in range(3)}


def test_no_rows(spark):
    none = spark.createDataFrame([], "g int, x double")
    assert tuple(sums.grouped(none, [], "x", COLUMNS).first()) == (None, None, 0, 0)
    assert sums.grouped(none, ["g"], "x", COLUMNS).count() == 0


def test_kpis_of_doubles_on_any_partitioning(spark):
    draw = random.Random(5)
    fact = spark.createDataFrame(
        [(f"t{i}", f"a{i % 40}", f"c{i % 30}", f"b{i % 7}", draw.uniform(-1e5, 1e7), f"k{i % 3}") for i in range(3000)],
        "transaction_id string, account_id string, customer_id string, branch_id string, transaction_amount double, transaction_type string",
    ).withColumn("transaction_date", F.expr("date_add(DATE '2024-01-01', int(substr(transaction_id, 2)) % 400)"))
    accounts = spark.createDataFrame([(f"a{i}", f"y{i % 2}") for i in range(40)], "account_id string, account_type string")
    plans = {
        **{p.__name__: p for p in (
            star.kpi_total_business, star.kpi_transaction_type, star.kpi_top_customers, star.kpi_branch_performance,
            star.kpi_monthly_trend, star.kpi_customer_branch,
        )},
        "kpi_account_type": lambda fact: star.kpi_account_type(fact, accounts),
    }
    for name, plan in plans.items():
        results = {tuple(sorted(map(tuple, plan(fact.repartition(n, "transaction_id")).collect()))) for n in (1, 5, 11)}
        assert len(results) == 1, name
