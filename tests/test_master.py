"""Both grains against the wide table, joined out on small data."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import master

SUMMARIES = [
    master.customer_summary,
    master.branch_performance,
    master.loan_analysis,
    master.transaction_summary,
    master.monthly_trends,
]


def make(spark, customers, accounts, transactions, loans, branches):
    full = {
        "customers": "customer_id string, first_name string, last_name string, email string, phone_number bigint, "
        "city string, occupation string, dob date",
        "accounts": "account_id string, customer_id string, branch_id string, account_type string, "
        "account_status string, opening_balance double, account_open_date date",
        "transactions": "transaction_id string, account_id string, transaction_type string, "
        "transaction_media string, transaction_amount double, transaction_date date",
        "loans": "loan_id string, customer_id string, branch_id string, loan_amount double, loan_type string, "
        "loan_status string",
        "branches": "branch_id string, branch_name string, city string, branch_state string",
    }
    given = dict(customers=customers, accounts=accounts, transactions=transactions, loans=loans, branches=branches)
    tables = {}
    for name, schema in full.items():
        columns = [c.strip().split(" ") for c in schema.split(",")]
        exprs = [e if e else f"cast(NULL AS {t}) AS {c}" for (c, t), e in ((ct, given[name][1].get(ct[0])) for ct in columns)]
        tables[name] = given[name][0].selectExpr(*exprs)
    return tables


@pytest.fixture(scope="module")
def tables(spark):
    """40 customers (some without accounts), 60 accounts (some of unknown
    customers), one account with a third of the transactions, uneven loans."""
    return make(
        spark,
        (spark.range(40), {"customer_id": "concat('C', id) AS customer_id"}),
        (
            spark.range(60),
            {
                "account_id": "concat('A', id) AS account_id",
                "customer_id": "concat('C', (id * 7) % 44) AS customer_id",
                "branch_id": "concat('B', id % 4) AS branch_id",
                "opening_balance": "CASE WHEN id % 9 > 0 THEN double(id * 1000.25) END AS opening_balance",
            },
        ),
        (
            spark.range(300),
            {
                "transaction_id": "concat('T', id) AS transaction_id",
                "account_id": "concat('A', CASE WHEN id % 3 = 0 THEN 5 ELSE (id * 11) % 55 END) AS account_id",
                "transaction_type": "CASE id % 2 WHEN 0 THEN 'Deposit' ELSE 'Transfer' END AS transaction_type",
                "transaction_amount": "double(id * 0.25) AS transaction_amount",
                "transaction_date": "date_add(DATE '2024-01-01', int(id)) AS transaction_date",
            },
        ),
        (
            spark.range(50),
            {
                "loan_id": "concat('L', id) AS loan_id",
                "customer_id": "concat('C', (id * id) % 47) AS customer_id",
                "loan_amount": "double(id * 100) AS loan_amount",
                "loan_type": "concat('type ', id % 3) AS loan_type",
            },
        ),
        (spark.range(4), {"branch_id": "concat('B', id) AS branch_id"}),
    )


@pytest.fixture(scope="module")
def wide(spark, tables):
    t = tables
    loans = t["loans"].drop("branch_id")
    return (
        t["customers"]
        .join(t["accounts"], "customer_id", "left")
        .join(t["transactions"], "account_id", "left")
        .join(loans, "customer_id", "left")
        .cache()
    )


def literal(wide):
    """The summaries of the wide table as plain aggregates."""
    total, mean, count = F.sum("transaction_amount"), F.avg("opening_balance"), F.count("transaction_id")
    return {
        "customer_summary": wide.groupBy("customer_id").agg(F.sum("opening_balance"), total, mean, count),
        "branch_performance": wide.groupBy("branch_id").agg(total, count, mean),
        "loan_analysis": wide.groupBy("loan_type").agg(F.count("*"), F.avg("loan_amount")),
        "transaction_summary": wide.groupBy("transaction_type").agg(total, F.count("*")),
        "monthly_trends": wide.groupBy(F.year("transaction_date"), F.month("transaction_date")).agg(total, count),
    }


def rounded(df):
    return sorted(
        (tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize("plan", SUMMARIES, ids=lambda p: p.__name__)
@pytest.mark.parametrize("scale", [None, 2])
def test_joined_grain_equals_the_wide_table(tables, wide, plan, scale):
    assert rounded(plan(tables, master.JOINED, scale)) == rounded(literal(wide)[plan.__name__])


def test_master_table_is_the_chain_of_left_joins(tables, wide):
    columns = ["customer_id", "account_id", "transaction_id", "loan_id"]
    assert rounded(master.master_table(tables).select(columns)) == rounded(wide.select(columns))
    facts = master.master_fact(tables, master.JOINED).select("customer_id", "account_id", "transaction_id")
    assert rounded(facts) == rounded(wide.select("customer_id", "account_id", "transaction_id"))


def test_top_joined_rows(tables, wide):
    order = [F.col("opening_balance").desc_nulls_last(), "account_id", "customer_id", "transaction_id", "loan_id"]
    columns = ["opening_balance", "account_id", "customer_id", "transaction_id", "loan_id"]
    for k in (1, 7, 30):
        got = master.top_customers(tables, master.JOINED, k).select(columns).collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in wide.orderBy(*order).limit(k).select(columns).collect()]


@pytest.fixture(scope="module")
def fan(spark):
    """One customer and account (100), two transactions (5, 7), three loans."""
    return make(
        spark,
        (spark.range(1), {"customer_id": "'C' AS customer_id"}),
        (
            spark.range(1),
            {
                "account_id": "'A' AS account_id",
                "customer_id": "'C' AS customer_id",
                "branch_id": "'B' AS branch_id",
                "opening_balance": "100D AS opening_balance",
            },
        ),
        (
            spark.range(2),
            {
                "transaction_id": "concat('T', id) AS transaction_id",
                "account_id": "'A' AS account_id",
                "transaction_amount": "5D + 2 * id AS transaction_amount",
            },
        ),
        (
            spark.range(3),
            {"loan_id": "concat('L', id) AS loan_id", "customer_id": "'C' AS customer_id", "loan_amount": "1D AS loan_amount"},
        ),
        (spark.range(1), {"branch_id": "'B' AS branch_id"}),
    )


def test_fan_out(fan):
    exact, joined = (master.customer_summary(fan, g).first() for g in (master.EXACT, master.JOINED))
    assert (exact.total_balance, exact.total_transaction_amount, exact.transaction_count) == (100, 12, 2)
    assert (joined.total_balance, joined.total_transaction_amount, joined.transaction_count) == (600, 36, 6)
    assert master.high_risk_customers(fan).first().n_loans == 3
    assert master.high_risk_customers(fan, master.JOINED).count() == 6
    assert master.loan_analysis(fan, master.JOINED).first().total_loans == 6


def test_segment_boundaries(spark):
    balances = [50000.0, 50000.01, 20000.0, 20000.01, None]
    df = spark.createDataFrame([(b,) for b in balances], "opening_balance double")
    got = [r.s for r in df.select(master._segment(master.BANDS).alias("s")).collect()]
    assert got == ["Medium Value", "High Value", "Low Value", "Medium Value", "Low Value"]


def test_unknown_grain_is_refused(fan):
    with pytest.raises(ValueError):
        master.customer_summary(fan, "other")


@pytest.mark.parametrize("piece", [1000, 7, 1])
def test_factors_expand_to_the_wide_table(tables, rows, piece):
    wide = master.master_table(tables)
    got = master.expanded(master.factored(tables, piece))
    assert sorted(got.columns) == sorted(wide.columns)
    assert rows(got, *wide.columns) == rows(wide, *wide.columns)


def test_factors_are_as_large_as_the_sum(fan):
    """The product is not stored, and a customer with many rows is many pieces."""
    factors = master.factored(fan, 10)
    sizes = {name: f.select(F.size("rows").alias("n"), "customer_id").collect() for name, f in factors.items()}
    accounts, moves, loans = (fan[n].count() for n in ("accounts", "transactions", "loans"))
    assert sum(r.n for r in sizes["moves"]) <= accounts + moves
    assert sum(r.n for r in sizes["lent"]) <= fan["customers"].count() + loans
    assert all(r.n <= 40 for name in sizes for r in sizes[name])
    assert master.expanded(factors).count() == master.master_table(fan).count()


def test_pieces_are_counted_before_the_wide_join(tables):
    """The branches are joined to the accounts once: the sizes of the pieces do not need them."""
    plan = master.factored(tables)["moves"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftOuter, (branch_id") == 2  # matched accounts, and lone ones
