"""CSV files to gold tables, laziness, and the shape of plans."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.model import ENTITIES
from ledgerloom.operators import integrity
from ledgerloom.operators.dedup import latest_by
from ledgerloom.operators.quantile import quantile
from ledgerloom.plans import master, pipeline, star
from ledgerloom.sources.raw import read_raw
from ledgerloom.sources.tables import current, read_table, store, write_table

FILES = {
    "Bank_Customer_1.csv": "customer_id,first_name,last_name,email,phone,city\nc1,ann,lee,a@x,555-0001,york\nc2,,poe,,,\n",
    "Bank_Customer_2.csv": "customer_id,first_name,last_name,email,phone,city\nC1,ann,lee,a@x,555-0001,york\n,x,x,x,1,x\n",
    "Bank_Branch_1.csv": "BRANCH_ID,BRANCH_NAME,BRANCH_STATE\nb1,Elm,ohio\n",
    "Bank_Account_1.csv": "account_id,customer_id,branch_id,account_type,balance,created_date\n"
    "a1,c1,b1,savings,1000.50,2024-01-01\na2,c2,b1,,,\na3,c9,b1,current,1,2024-01-01\n",
    "Bank_Loan_1.csv": "LOAN_ID,CUSTOMER_ID,BRANCH_ID,LOAN_AMOUNT\nl1,c1,b1,5000\n",
    "Bank_Transacation_1.csv": "TRANSCATION_ID,ACCOUNT_ID,TRANSCATION_TYPE,TRANSCATION_MEDIA,TRANSCATION_AMOUNT,"
    "TRANSCATION_DATE\nt1,a1,deposit,Online,10,2024-01-05\nt2,a1,deposit,Online,30,2024-02-05\n"
    "t2,a1,deposit,Online,40,2024-02-06\nt3,a3,deposit,Online,7,2024-02-06\nt4,a2,,,,\n",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw")
    for name, content in FILES.items():
        (path / name).write_text(content)
    return str(path)


def test_csv_columns_are_matched_by_name(spark, folder, rows):
    branches = read_raw(spark, ENTITIES["branches"], folder)
    assert rows(branches) == [("b1", "Elm", None, "ohio")]
    customers = read_raw(spark, ENTITIES["customers"], folder)
    assert customers.count() == 4 and set(dict(customers.dtypes).values()) == {"string"}
    only = read_raw(spark, ENTITIES["customers"], folder, glob="*_2.csv")
    assert rows(only, "customer_id") == [("C1",), (None,)]
    header = ["BRANCH_ID", "BRANCH_NAME", "BRANCH_STATE"]
    assert rows(read_raw(spark, ENTITIES["branches"], folder, header_names=header)) == rows(branches)


def test_store_round_trip(spark, tmp_path, rows):
    df = spark.range(5).selectExpr("id", "concat('v', id) AS v")
    assert rows(store(df, f"{tmp_path}/t")) == rows(df)
    assert rows(store(df.limit(2), f"{tmp_path}/t", fmt="orc")) == rows(df.limit(2))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS books LOCATION '{tmp_path}/books'")
    write_table(df, "books.kept")
    write_table(df.limit(3), "books.kept")
    assert read_table(spark, "books.kept").count() == 3
    spark.sql("DROP DATABASE books CASCADE")


@pytest.fixture(scope="module")
def gold(spark, folder, tmp_path_factory):
    options = pipeline.Options(exact=True, scale=2, split_hot_keys=True)
    return pipeline.run(pipeline.read_sources(spark, folder), str(tmp_path_factory.mktemp("lake")), options)


def test_run_from_files_to_gold(gold, rows):
    assert rows(gold["kept_accounts"], "account_id", "opening_balance") == [("A1", 1000.5), ("A2", 1.0)]
    assert rows(gold["fact_transactions"], "transaction_id", "customer_id", "transaction_amount") == [
        ("T1", "C1", 10.0),
        ("T2", "C1", 40.0),
        ("T4", "C2", 10.0),
    ]
    assert rows(gold["kpi_total_business"]) == [(3, 60.0, 20.0)]
    assert rows(gold["kpi_monthly_trend"], "month", "txn_count") == [("1900-01", 1), ("2024-01", 1), ("2024-02", 1)]
    assert rows(gold["kpi_high_value_txn"], "transaction_id") == [("T2",)]
    assert rows(gold["ri_report"], "orphans") == [(0,), (0,), (0,), (0,), (1,)]
    assert rows(gold["ri_report_after"], "orphans") == [(0,)] * 5
    assert rows(gold["customer_risk_score"], "customer_id", "risk_band") == [("C1", "High"), ("C2", "Low")]


def test_run_only_what_is_asked(spark, folder, tmp_path):
    got = pipeline.run(pipeline.read_sources(spark, folder), f"{tmp_path}/lake", only={"dim_customers"})
    assert set(got) == {"bronze_customers", "silver_customers", "dim_customers"}


@pytest.fixture(params=["folder", "database"])
def place(request, spark, tmp_path):
    if request.param == "folder":
        yield f"{tmp_path}/lake"
        return
    spark.sql(f"CREATE DATABASE lake LOCATION '{tmp_path}/lake'")
    yield "lake"
    spark.sql("DROP DATABASE lake CASCADE")


def numbers(spark, place, names):
    """The version at hand of each dataset."""
    found = {n: current(spark, f"{place}/{n}" if "/" in place else f"{place}.{n}") for n in names}
    return {n: v.number for n, v in found.items() if v}


WANTED = {"kpi_total_business", "dim_branches", "master_loan_analysis"}


def test_a_broken_run_goes_on_where_it_stopped(spark, folder, place, rows, monkeypatch):
    options = pipeline.Options(exact=True, scale=2)
    with monkeypatch.context() as patch:
        patch.setattr(star, "fact_transactions", lambda *_: spark.range(3).selectExpr("raise_error('lost') AS x"))
        with pytest.raises(Exception, match="lost"):
            pipeline.run(pipeline.read_sources(spark, folder), place, options, only=WANTED)
    names = set(pipeline.datasets(options))
    before = numbers(spark, place, names)
    assert "silver_accounts" in before and "fact_transactions" not in before
    got = pipeline.run(pipeline.read_sources(spark, folder), place, options, only=WANTED)
    assert rows(got["kpi_total_business"]) == [(3, 60.0, 20.0)]
    after = numbers(spark, place, names)
    assert before.items() <= after.items() and set(after.values()) == {1}


def test_only_what_depends_on_a_change_is_built_anew(spark, tmp_path, rows):
    for name, content in FILES.items():
        (tmp_path / name).write_text(content)
    place, options = f"{tmp_path}/lake", pipeline.Options(exact=True, scale=2)

    def run(options):
        got = pipeline.run(pipeline.read_sources(spark, str(tmp_path)), place, options, only=WANTED)
        return got, numbers(spark, place, got)

    _, first = run(options)
    assert run(options)[1] == first
    (tmp_path / "Bank_Loan_1.csv").write_text(FILES["Bank_Loan_1.csv"] + "l2,c1,b1,7000\n")
    got, second = run(options)
    assert rows(got["master_loan_analysis"]) == [(None, 2, 6000.0)]
    changed = {n for n in first if second[n] != first[n]}
    assert {"bronze_loans", "kept_loans"} <= changed and not changed & {"fact_transactions", "kpi_total_business", "silver_accounts"}
    _, third = run(pipeline.Options(exact=True, scale=3))
    assert {n for n in third if third[n] != second[n]} == {"kpi_total_business", "master_loan_analysis"}
    run(pipeline.Options(exact=False, scale=3))
    plain = pipeline.run(pipeline.read_sources(spark, str(tmp_path)), place, options, only=WANTED, resume=False)
    assert min(numbers(spark, place, plain).values()) > min(third.values())


def test_injected_dirt_survives_the_pipeline(spark, folder, tmp_path):
    options = pipeline.Options(inject=True, seed=4, enforce=False, require_fk=False)
    got = pipeline.run(pipeline.read_sources(spark, folder), f"{tmp_path}/lake", options, only={"kpi_total_business"})
    assert got["kpi_total_business"].count() == 1


def test_building_datasets_runs_no_job(spark, gold):
    """All plans are built without an action, so they stay lazy."""
    sources = {f"source_{name}": gold[f"bronze_{name}"] for name in ENTITIES}
    tables = {**sources, **gold}
    spark.sparkContext.setJobGroup("lazy", "plans only")
    for dataset in pipeline.datasets(pipeline.Options(exact=True, split_hot_keys=True)).values():
        dataset.build(tables)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = physical(latest_by(df, "k", ["k", "v"]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Partial") > plan.index("Exchange")


def test_dedup_shuffles_no_column_twice(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "if(id % 2 = 0, '-', string(id)) AS v", "coalesce(date(null), DATE '1900-01-01') AS d")
    kept = latest_by(df, "k", ["k", "v", "d"], "d", missing={"v": F.lit("-"), "d": F.lit("1900-01-01").cast("date")})
    assert "_w0" not in physical(kept)
    assert sorted((r.k, r.v, str(r.d)) for r in kept.collect()) == [(0, "15", "1900-01-01"), (1, "1", "1900-01-01"), (2, "11", "1900-01-01")]


def test_dedup_tells_null_from_the_missing_value(spark):
    df = spark.createDataFrame([("a", None), ("b", "-"), ("c", "x"), ("c", "-"), ("c", None)], "k string, v string")
    kept = latest_by(df, "k", ["k", "v"], missing={"v": F.lit("-")})
    assert sorted((r.k, r.v) for r in kept.collect()) == [("a", None), ("b", "-"), ("c", "x")]


def test_no_cross_joins(gold):
    tables = {**gold, **{f"source_{n}": gold[f"bronze_{n}"] for n in ENTITIES}}
    for name, dataset in pipeline.datasets(pipeline.Options(exact=True)).items():
        plan = physical(dataset.build(tables))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_kpis_read_only_their_columns(gold):
    plan = physical(star.kpi_branch_performance(gold["fact_transactions"]))
    assert "ReadSchema: struct<branch_id:string,transaction_amount:double>" in plan
    plan = physical(star.kpi_high_value_txn(gold["fact_transactions"]))
    assert "PushedFilters: [IsNotNull(transaction_amount)" in plan
    assert "ReadSchema: struct<transaction_amount:double>" in physical(
        quantile(gold["fact_transactions"], "transaction_amount", 0.9)
    )


def test_ordering_and_limits_are_options(gold):
    fact = gold["fact_transactions"]
    assert [r.customer_id for r in star.kpi_top_customers(fact, order=True).collect()] == ["C1", "C2"]
    assert star.kpi_customer_branch(fact, k=1).count() == 1
    assert [r.month for r in star.kpi_monthly_trend(fact, order=True, exclude_sentinel=True).collect()] == [
        "2024-01",
        "2024-02",
    ]


def test_top_rows_of_a_run_are_read_from_its_first_files(spark, folder, tmp_path):
    options = pipeline.Options(exact=True, scale=2)
    pipeline.run(pipeline.read_sources(spark, folder), f"{tmp_path}/lake", options, only=set(pipeline.ORDERS))
    got = pipeline.top(spark, f"{tmp_path}/lake", "kpi_top_customers", 1)
    assert [(r.customer_id, r.total_spent) for r in got.collect()] == [("C1", 50.0)]
    assert len(got.inputFiles()) == 1 and "TakeOrderedAndProject" in physical(got)
    assert [r.month for r in pipeline.top(spark, f"{tmp_path}/lake", "kpi_monthly_trend", 2).collect()] == ["1900-01", "2024-01"]


def exchanges(df):
    return physical(df).count("Exchange hashpartitioning")


def test_exact_master_sums_take_one_shuffle_for_the_groups(gold):
    """Two semi joins and one aggregate; none per account, customer and month. Sums of doubles
    take one more, of a few rows for each group."""
    tables = {n: gold[f"{'kept' if e.foreign_keys else 'silver'}_{n}"] for n, e in ENTITIES.items()}
    for plan in (master.monthly_trends, master.transaction_summary):
        exact, doubles, joined = plan(tables, master.EXACT, 2), plan(tables, master.EXACT), plan(tables, master.JOINED, 2)
        assert physical(exact).count("HashAggregate") == 2
        assert exchanges(doubles) == exchanges(exact) + 1
        assert exchanges(exact) < exchanges(joined)


def test_report_reads_each_child_once(gold):
    tables = {n: gold[f"silver_{n}"] for n in ENTITIES}
    plan = physical(integrity.ri_report(tables))
    assert plan.count("struct<loan_id") == 0
    assert sum("customer_id:string,branch_id:string" in line for line in plan.splitlines() if "ReadSchema" in line) == 2


def test_bucketed_tables_are_joined_without_a_shuffle(spark, folder, tmp_path, rows, gold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.sql(f"CREATE DATABASE vault LOCATION '{tmp_path}/vault'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        options = pipeline.Options(exact=True, scale=2, buckets=3)
        got = pipeline.run(pipeline.read_sources(spark, folder), "vault", options)
        for name in ("fact_transactions", "kept_transactions", "kept_loans", "kpi_account_type", "ri_report", "kpi_customer_branch"):
            columns = [c for c in got[name].columns if c != "_silver_loaded_at"]
            assert rows(got[name], *columns) == rows(gold[name], *columns), name
        plans = pipeline.datasets(options)
        for name in ("marked_transactions", "fact_transactions"):
            plan = physical(plans[name].build(got))
            assert "SortMergeJoin" in plan and "Exchange" not in plan, name
        # Above the join there is one, by account type.
        plan = physical(plans["kpi_account_type"].build(got))
        assert "Exchange" not in plan[plan.index("SortMergeJoin") :]
        # A second run stores into the same tables.
        again = pipeline.run(pipeline.read_sources(spark, folder), "vault", options, only={"fact_transactions"}, resume=False)
        assert rows(again["fact_transactions"]) == rows(gold["fact_transactions"])
        assert "Exchange" not in physical(plans["fact_transactions"].build(again))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP DATABASE vault CASCADE")
