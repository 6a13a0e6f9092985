"""Overwrites that cannot lose what is stored."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import tables
from ledgerloom.sources.tables import Buckets, Conflict, current, read_table, store, versions, write_table


@pytest.fixture()
def books(spark, tmp_path):
    spark.sql(f"CREATE DATABASE books LOCATION '{tmp_path}/my books'")
    yield "books"
    spark.sql("DROP DATABASE books CASCADE")


@pytest.fixture(params=["path", "name"])
def target(request, tmp_path):
    return f"{tmp_path}/a folder [1]/kept" if request.param == "path" else f"{request.getfixturevalue('books')}.kept"


@pytest.fixture()
def five(spark):
    return spark.range(5).selectExpr("id", "concat('v', id) AS v")


def broken(df):
    """Fails in the task that has the last row, after others were written."""
    return df.repartition(3).withColumn("v", F.when(F.col("id") == 4, F.raise_error(F.lit("no such row"))).otherwise(F.col("v")))


def test_a_failed_overwrite_keeps_the_old_rows(spark, target, five, rows):
    store(five, target)
    with pytest.raises(Exception, match="no such row"):
        store(broken(five), target)
    assert rows(read_table(spark, target)) == rows(five)
    assert [v.number for v in versions(spark, target)] == [1]
    assert rows(store(five.limit(2), target)) == rows(five.limit(2))
    assert rows(read_table(spark, target, number=1)) == rows(five)


def test_a_failed_first_write_leaves_nothing(spark, target, five):
    with pytest.raises(Exception, match="no such row"):
        store(broken(five), target)
    assert versions(spark, target) == []


def test_a_dataset_is_overwritten_from_itself(spark, target, five, rows):
    store(five, target)
    for turn in range(1, 4):
        grown = read_table(spark, target).withColumn("id", F.col("id") + 1)
        assert sorted(r.id for r in store(grown, target).collect()) == [i + turn for i in range(5)]
    assert rows(read_table(spark, target), "v") == rows(five, "v")


def test_readers_go_on_with_their_version(spark, target, five, rows):
    old = store(five, target)
    path = current(spark, target).path
    store(five.limit(1), target)
    assert rows(spark.read.parquet(tables.literal(path))) == rows(five)
    assert "name" in target or rows(old) == rows(five)


def test_old_versions_and_leavings_are_removed(spark, tmp_path, five):
    target = f"{tmp_path}/kept"
    store(five, target)
    five.write.parquet(f"{target}/_versions/{0:08d}-broken")
    for n in range(1, 5):
        store(five.limit(n), target)
    assert [v.number for v in versions(spark, target)] == [4, 5]
    assert len(os.listdir(f"{target}/_versions")) == 2
    assert [read_table(spark, target, number=n).count() for n in (4, 5)] == [3, 4]


def test_columns_and_format_may_change(spark, target, five, rows):
    store(five, target)
    wider = five.selectExpr("id", "id * 2.5 AS w", "v")
    assert rows(store(wider, target, fmt="orc")) == rows(wider)
    assert rows(read_table(spark, target)) == rows(wider)
    assert store(five.select("v"), target).columns == ["v"]


def test_plain_files_of_a_path_are_replaced_after_the_write(spark, tmp_path, five, rows):
    path = f"{tmp_path}/plain"
    five.write.parquet(path)
    assert rows(read_table(spark, path)) == rows(five)
    with pytest.raises(Exception, match="no such row"):
        store(broken(five), path)
    assert rows(read_table(spark, path)) == rows(five)
    assert rows(store(read_table(spark, path).where("id < 3"), path)) == rows(five.where("id < 3"))
    assert sorted(os.listdir(path)) == ["_current", "_versions"]


def test_two_writers_of_one_version(spark, tmp_path, five, rows, monkeypatch):
    """The second writer saw the dataset before the first one ended."""
    target = f"{tmp_path}/kept"
    store(five, target)
    seen = versions(spark, target)
    store(five.limit(1), target)
    monkeypatch.setattr(tables, "versions", lambda *_: seen)
    with pytest.raises(Conflict):
        store(five.limit(2), target)
    monkeypatch.undo()
    assert read_table(spark, target).count() == 1


def test_a_move_that_broke_off_is_finished(spark, books, five, rows):
    write_table(five, "books.kept")
    path = current(spark, "books.kept").path
    spark.catalog.createTable("books.kept__next", path=path, source="parquet", schema=five.schema)
    spark.sql("DROP TABLE books.kept")
    assert rows(read_table(spark, "books.kept")) == rows(five)
    write_table(five.limit(2), "books.kept")
    assert read_table(spark, "books.kept").count() == 2


def test_an_empty_dataset_keeps_its_columns(spark, target, five):
    got = store(five.limit(0), target)
    assert got.columns == ["id", "v"] and got.count() == 0


def test_buckets_come_and_go(spark, books, five, rows):
    for buckets in (None, Buckets(3, "id"), Buckets(3, "id"), Buckets(2, "id"), None):
        got = store(five, "books.kept", buckets=buckets)
        assert rows(got) == rows(five)
        plan = got.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange" not in plan) == bool(buckets)
    assert [t.name for t in spark.catalog.listTables("books")] == ["kept"]


def test_the_first_rows_come_from_the_first_file(spark, target):
    frame = spark.range(2000).selectExpr("id", "CASE WHEN id % 7 = 3 THEN NULL ELSE (id * 37) % 500 END AS n").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store(frame, target, order=("-n", "id"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = current(spark, target).parts
    assert len(parts) > 2 and sum(n for _, n in parts) == 2000
    want = sorted(((r.id, r.n) for r in frame.collect()), key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    for k, files in ((5, 1), (parts[0][1], 1), (parts[0][1] + 1, 2), (3000, len(parts))):
        got = tables.head(spark, target, k)
        assert [tuple(r) for r in got.collect()] == want[:k]
        assert len(got.inputFiles()) == files
    store(frame.limit(0), target, order=("-n", "id"))
    assert tables.head(spark, target, 3).collect() == []
    store(frame, target)
    with pytest.raises(ValueError, match="not stored in order"):
        tables.head(spark, target, 3)
