import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.skew import hot_keys, outer_join_many, parent_join, sliced_join


@pytest.fixture(scope="module")
def child(spark):
    """A third of the rows on one key, some rows without a key or a parent."""
    key = "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('k', id % 700) END"
    return spark.range(6000).selectExpr("id", f"{key} AS k").repartition(4)


@pytest.fixture(scope="module")
def parent(spark):
    return spark.range(600).selectExpr("concat('k', id) AS k", "id AS v").union(spark.sql("SELECT 'hot', -1L"))


def test_hot_keys_are_found_and_bounded(child):
    hot = {r.k: r.slices for r in hot_keys(child, "k", share=0.01).collect()}
    assert list(hot) == ["hot"] and 30 <= hot["hot"] <= 40


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_sliced_join_is_the_plain_join(child, parent, rows, how):
    hot = hot_keys(child, "k", share=0.01)
    plain = child.join(parent, "k", how)
    sliced = sliced_join(child, parent, "k", how, hot, ("id",))
    assert rows(sliced, *plain.columns) == rows(plain)


def test_probed_keys_do_not_depend_on_the_order_of_rows(child):
    found = [sorted(hot_keys(child.repartition(n), "k", 0.01, probe=10, by=("id",)).collect()) for n in (1, 3, 8)]
    assert found[0] == found[1] == found[2] and [r.k for r in found[0]] == ["hot"]


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_no_rows_are_lost_without_exchange_reuse(spark, child, parent, rows, how):
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        shuffled = child.repartition(5).groupBy("id", "k").count().drop("count")
        hot = hot_keys(shuffled, "k", 0.01, probe=7, by=("id",))
        assert rows(sliced_join(shuffled, parent, "k", how, hot, ("id",)), "id", "k") == rows(child.join(parent, "k", how), "id", "k")
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)


def test_slices_even_out_a_hot_key(spark, child):
    hot = hot_keys(child, "k", share=0.01)
    dealt = child.join(hot, "k").withColumn("s", F.pmod(F.xxhash64("id"), F.col("slices").cast("long")))
    largest = dealt.groupBy("k", "s").count().agg(F.max("count")).first()[0]
    assert largest < 2000 / 10


def test_sliced_join_rejects_joins_that_show_repeats(child, parent):
    with pytest.raises(ValueError):
        sliced_join(child, parent, "k", "right", hot_keys(child, "k"), ("id",))


def test_semi_join_keeps_column_order(child, parent):
    assert parent_join(child, parent.select("k"), "k", "left_semi").columns == ["id", "k"]


def test_outer_join_many_is_the_left_join(child, parent, rows):
    plain = parent.join(child, "k", "left")
    assert rows(outer_join_many(parent, child, "k"), *plain.columns) == rows(plain)


def test_adaptive_execution_splits_the_hot_partition(spark, child, parent):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = outer_join_many(parent, child, "k")
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
