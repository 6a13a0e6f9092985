"""Exact sums are right or fail; nothing is rounded or left out."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import measures as m


@pytest.fixture(params=["true", "false"], ids=["ansi", "no_ansi"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def summed(spark, values, scale, type="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {type}")
    return tuple(df.agg(m.total("x", "t", scale), m.mean("x", "a", scale)).first())


@pytest.mark.parametrize(
    ("values", "scale", "want"),
    [
        ([1.0, 2e16, 0.5], 2, (20000000000000002.0, 20000000000000001.5 / 3)),
        ([0.004, 1.125, None], 3, (1.129, 1.129 / 2)),
        ([0.1] * 10, 1, (1.0, 0.1)),
        ([None, None], 2, (None, None)),
        ([-5.25, 5.25], 2, (0.0, 0.0)),
    ],
)
def test_what_fits_is_exact(spark, ansi, values, scale, want):
    assert summed(spark, values, scale) == pytest.approx(want, rel=1e-15) if want[0] is not None else want == (None, None)


@pytest.mark.parametrize("bad", [0.004, float("nan"), float("inf"), -float("inf"), 1e40])
def test_what_does_not_fit_is_an_error(spark, ansi, bad):
    with pytest.raises(Exception, match="at most 2 decimals"):
        summed(spark, [5.0, bad], 2)


def test_sums_and_weights_that_overflow_are_errors(spark, ansi):
    big = spark.range(20).select(F.lit("9" * 36).cast("decimal(36,0)").cast("decimal(38,2)").alias("x"), F.lit(10**17).alias("w"))
    with pytest.raises(Exception, match="38 digits"):
        big.union(big).union(big).union(big).union(big).union(big).agg(m.again("x", 2).alias("t")).first()
    with pytest.raises(Exception, match="38 digits"):
        big.agg(m.weighted("x", F.col("w"), 2).alias("t")).first()


def test_weighted_sums(spark, ansi):
    df = spark.createDataFrame([(2.5, 3), (None, 4), (1.25, 1)], "x double, w bigint")
    assert df.agg(m.weighted("x", F.col("w"), 2).cast("double").alias("t")).first().t == 8.75


def test_doubles_keep_their_rules(spark):
    assert summed(spark, [1.0, float("inf")], None) == (float("inf"), float("inf"))
