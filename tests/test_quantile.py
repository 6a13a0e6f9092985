import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.quantile import ERROR, impute_median, quantile


def disc(values, p):
    """Smallest value whose share of rows at or below it reaches p."""
    known = sorted(v for v in values if v is not None and math.isfinite(v))
    return known[max(1, math.ceil(p * len(known))) - 1] if known else None


def random_values(kind, n, seed=5):
    rng = random.Random(seed)
    if kind == "uniform":
        return [rng.random() for _ in range(n)]
    if kind == "wide":
        return [rng.choice([-1, 1]) * 10 ** rng.uniform(-8, 12) for _ in range(n)]
    if kind == "heavy":  # a third of the rows share one value
        return [7.0 if rng.random() < 0.34 else rng.gauss(7, 1) for _ in range(n)]
    if kind == "few":
        return [float(rng.randint(0, 3)) for _ in range(n)]
    if kind == "clusters":  # far apart, each with many values
        return [rng.choice([0.0, 1e18, -1e-12]) + rng.random() for _ in range(n)]
    if kind == "scales":
        return [rng.random() * 10.0 ** -rng.randint(0, 300) for _ in range(n)]
    if kind == "one":
        return [2.5] * n
    return [rng.choice([None, math.nan, math.inf, -math.inf, rng.gauss(0, 5)]) for _ in range(n)]


@pytest.mark.parametrize("kind", ["uniform", "wide", "heavy", "few", "holes", "clusters", "scales", "one"])
def test_exact_quantile_matches_brute_force(spark, kind):
    values = random_values(kind, 4000)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    for p in (0.5, 0.9):
        assert quantile(df, "v", p, exact=True).first()[0] == disc(values, p)


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [2.0, 2.0, 2.0], [None, None]])
def test_exact_quantile_of_tiny_tables(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert quantile(df, "v", 0.5, exact=True).first()[0] == disc(values, 0.5)


def test_sketch_of_few_rows_is_within_its_error(spark):
    n = 38161
    for parts in (1, 3, 5):
        x = spark.range(0, n, 1, parts).select((F.col("id") * 7919 % n + 1).cast("double").alias("x"))
        rank = quantile(x, "x", 0.9).first()[0]  # the value is its rank
        assert math.ceil((0.9 - 1e-4) * n) <= rank <= math.ceil((0.9 + 1e-4) * n)


def test_sketch_is_within_its_error(spark):
    values = random_values("uniform", 5000)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    for p in (0.1, 0.5, 0.9):
        got = quantile(df, "v", p).first()[0]
        assert abs(sum(v <= got for v in values) / len(values) - p) <= ERROR + 1 / len(values)


def test_impute_median(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 5.0), (4, 9.0)], "i int, v double")
    assert impute_median(df, "v", exact=True).filter("i = 2").first().v == 5.0
    empty = impute_median(df.filter("v IS NULL"), "v", exact=True)
    assert [r.v for r in empty.collect()] == [0.0]


def test_big_integers_are_not_rounded(spark):
    big = 2**60 + 1
    df = spark.createDataFrame([(big,), (None,), (big + 2,)], "v bigint")
    filled = impute_median(df, "v", type="bigint", exact=True)
    assert sorted(r.v for r in filled.collect()) == [big, big, big + 2]


def test_exact_quantile_reads_the_table_twice(spark):
    """Once for the bracket and once for the counts, which the later steps share."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(1000).selectExpr("double(id % 900) AS v").mapInArrow(count, "v double")
    assert quantile(df, "v", 0.5, exact=True).first()[0] == disc([float(i % 900) for i in range(1000)], 0.5)
    assert seen.value == 2000


@pytest.mark.parametrize("p", [0.0, 0.3, 1.0])
def test_neighbours_that_share_a_double_are_told_apart(spark, p):
    values = [2**60 + i for i in range(600)] + [-(2**60) - i for i in range(600)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(3)
    assert quantile(df, "v", p, exact=True).first()[0] == disc(values, p)
