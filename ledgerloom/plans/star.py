"""Star schema and the KPIs read from its fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import measures as m
from ledgerloom.functions.text import sentinel_day
from ledgerloom.operators import sketches, sums
from ledgerloom.operators.quantile import quantile
from ledgerloom.operators.skew import parent_join

# The columns of the star schema. The output names of the KPIs below are fixed, too.
DIM_CUSTOMERS = ["customer_id", "first_name", "last_name", "city"]
DIM_BRANCHES = ["branch_id", "branch_name", "branch_state"]
DIM_ACCOUNTS = ["account_id", "customer_id", "branch_id", "account_type", "opening_balance", "account_open_date"]
FACT = [
    "transaction_id",
    "account_id",
    "customer_id",
    "branch_id",
    "transaction_amount",
    "transaction_type",
    "transaction_date",
]
AMOUNT = "transaction_amount"


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(DIM_CUSTOMERS)


def dim_branches(branches: DataFrame) -> DataFrame:
    return branches.select(DIM_BRANCHES)


def dim_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.select(DIM_ACCOUNTS)


def fact_transactions(transactions: DataFrame, accounts: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Each transaction with the customer and branch of its account.

    Transactions of unknown accounts drop out, so given enforced accounts the
    transactions need no integrity join of their own. ``hot`` may give the
    accounts with very many transactions (``skew.hot_keys``).
    """
    moves = transactions.select("transaction_id", "account_id", AMOUNT, "transaction_type", "transaction_date")
    owners = accounts.select("account_id", "customer_id", "branch_id")
    return parent_join(moves, owners, "account_id", "inner", hot, ("transaction_id",)).select(FACT)


def _ranked(df: DataFrame, order: bool, k: int | None, by: Column, *ties: str) -> DataFrame:
    """Rows are the contract; order and a limit are for the reader's asking."""
    if k is not None:
        return df.orderBy(by, *ties).limit(k)
    return df.orderBy(by, *ties) if order else df


def kpi_total_business(fact: DataFrame, scale: int | None = None) -> DataFrame:
    columns = {
        "total_transactions": sums.known("transaction_id"),
        "total_revenue": sums.TOTAL,
        "avg_transaction_value": sums.MEAN,
    }
    return sums.grouped(fact, [], AMOUNT, columns, scale)


def kpi_transaction_type(fact: DataFrame, scale: int | None = None) -> DataFrame:
    columns = {"txn_count": sums.ROWS, "total_amount": sums.TOTAL}
    return sums.grouped(fact, ["transaction_type"], AMOUNT, columns, scale)


def kpi_top_customers(
    fact: DataFrame, order: bool = False, k: int | None = None, scale: int | None = None
) -> DataFrame:
    spent = sums.grouped(fact, ["customer_id"], AMOUNT, {"total_spent": sums.TOTAL, "txn_count": sums.ROWS}, scale)
    return _ranked(spent, order, k, F.desc("total_spent"), "customer_id")


def kpi_branch_performance(
    fact: DataFrame, order: bool = False, k: int | None = None, scale: int | None = None
) -> DataFrame:
    columns = {"total_transactions": sums.ROWS, "branch_revenue": sums.TOTAL}
    earned = sums.grouped(fact, ["branch_id"], AMOUNT, columns, scale)
    return _ranked(earned, order, k, F.desc("branch_revenue"), "branch_id")


def kpi_monthly_trend(
    fact: DataFrame, order: bool = False, exclude_sentinel: bool = False, scale: int | None = None
) -> DataFrame:
    """Undated transactions carry the sentinel day and show as month 1900-01
    unless ``exclude_sentinel`` is set."""
    dated = fact.filter(F.col("transaction_date") != sentinel_day()) if exclude_sentinel else fact
    month = F.date_format("transaction_date", "yyyy-MM").alias("month")
    trend = sums.grouped(dated, [month], AMOUNT, {"monthly_revenue": sums.TOTAL, "txn_count": sums.ROWS}, scale)
    return _ranked(trend, order, None, F.asc("month"))


def kpi_account_type(fact: DataFrame, accounts: DataFrame, scale: int | None = None) -> DataFrame:
    """The fact is summed per account before the join, so the join moves few
    rows per account and an account with very many transactions is one of them."""
    types = accounts.select("account_id", "account_type")
    if scale is None:
        columns = {"total_amount": sums.TOTAL, "txn_count": sums.ROWS}
        partial = sums.units(fact, ["account_id"], AMOUNT, columns).join(types, "account_id")
        return sums.finished(partial, ["account_type"], columns)
    per_account = fact.groupBy("account_id").agg(m.partial(AMOUNT, "amount", scale), m.rows("txns"))
    return per_account.join(types, "account_id").groupBy("account_type").agg(
        m.again("amount", scale).cast("double").alias("total_amount"), F.sum("txns").alias("txn_count")
    )


def kpi_customer_branch(
    fact: DataFrame, order: bool = False, k: int | None = None, scale: int | None = None
) -> DataFrame:
    pairs = sums.grouped(fact, ["customer_id", "branch_id"], AMOUNT, {"total_amount": sums.TOTAL}, scale)
    return _ranked(pairs, order, k, F.desc("total_amount"), "customer_id", "branch_id")


def kpi_high_value_txn(
    fact: DataFrame, q: float = 0.9, exact: bool = False, sketch: DataFrame | None = None
) -> DataFrame:
    """Transactions at or above the ``q`` quantile of all amounts.

    With a stored ``sketch`` of the amounts (:mod:`ledgerloom.operators.sketches`) the fact is read
    once. Without one ``fact`` should be a stored table: the quantile reads its amount
    column in passes of its own.
    """
    limit = quantile(fact, AMOUNT, q, exact).scalar() if exact or sketch is None else sketches.value(sketch, q)
    return fact.filter(F.col(AMOUNT) >= limit)
