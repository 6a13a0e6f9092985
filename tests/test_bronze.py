import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.draws import hit, threshold
from ledgerloom.model import CUSTOMERS, ENTITIES
from ledgerloom.plans import bronze


@pytest.fixture(scope="module")
def customers(spark):
    columns = [f"concat('{c} ', id) AS {c}" for c in CUSTOMERS.columns]
    return spark.range(20000).selectExpr(*columns)


def share(df, condition):
    return df.agg(F.avg(F.expr(condition).cast("int"))).first()[0]


def test_threshold_is_fixed_width_hex():
    assert [threshold(p) for p in (0.0, 0.1, 0.5, 1.0)] == ["0000", "199a", "8000", "g"]
    with pytest.raises(ValueError):
        threshold(1.5)


def test_draws_do_not_depend_on_partitioning(customers):
    column = hit(F.col("customer_id"), "x", 1, 0.2)
    one = customers.repartition(1).filter(column).count()
    assert one == customers.repartition(9).filter(column).count()
    assert abs(one / 20000 - 0.2) < 0.01


def test_nulls_fall_independently(customers):
    holes = bronze.inject_nulls(customers, CUSTOMERS.columns, F.col("customer_id"), seed=3)
    assert abs(share(holes, "email IS NULL") - 0.1) < 0.01
    assert abs(share(holes, "email IS NULL AND city IS NULL") - 0.01) < 0.004


def test_copies_are_exact(customers):
    copied = bronze.inject_duplicates(customers, F.col("customer_id"), seed=3)
    assert copied.columns == customers.columns
    assert abs(copied.count() / 20000 - 1.05) < 0.005
    assert copied.distinct().count() == 20000


def test_case_noise_shares(customers):
    noisy = bronze.inject_case_noise(customers, ["email"], F.col("customer_id"), seed=3)
    assert abs(share(noisy, "email = upper(email)") - 0.30) < 0.01
    same = bronze.inject_case_noise(customers.withColumn("email", F.lit("Ab")), ["email"], F.col("customer_id"), 3)
    assert abs(share(same, "email = 'ab'") - 0.35) < 0.01


def test_bronze_has_no_missing_text(spark, customers):
    dirty = bronze.bronze(customers, CUSTOMERS, F.col("customer_id"), seed=1)
    assert dirty.columns == CUSTOMERS.columns
    assert share(dirty, "email IS NULL") == 0 and abs(share(dirty, "email = ''") - 0.1) < 0.01
    plain = ENTITIES["branches"]
    branches = spark.range(50).selectExpr(*[f"'Xy' AS {c}" for c in plain.columns])
    dirty = bronze.bronze(branches, plain, F.col("branch_id"))
    assert {r.city for r in dirty.collect()} <= {"Xy", ""}
