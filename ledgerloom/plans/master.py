"""Analytics over the wide master table, without building it.

The master table hangs accounts, transactions, loans and branches off every
customer with left joins, so an account's row repeats for each of its
transactions and each loan of its customer. Every summary takes a ``grain``:

``exact``   (default) every account, transaction and loan counts once;
``joined``  the numbers the wide table itself would give, repeats included.

Neither multiplies anything out. A row of the wide table occurs a known number
of times: an account ``max(1, its transactions) * max(1, its customer's loans)``
times, a transaction ``max(1, loans)`` times. Facts are summed per account and
then per customer, and those sums are weighted by the repeats; no join in a
summary meets more rows per key than there are groups. Only results that are
wide rows by definition (``master_table`` and the joined form of the row level
queries) are joined out; give these stored tables, as they read some twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import measures as m
from ledgerloom.operators import sums
from ledgerloom.operators.skew import outer_join_many
from ledgerloom.plans.star import FACT

Tables = Mapping[str, DataFrame]
EXACT, JOINED = "exact", "joined"

# Segment bands, the low balance of a risky borrower, top count.
BANDS = (50000, 20000)
LOW_BALANCE = 1000
TOP = 10


def _repeats(grain: str) -> bool:
    if grain not in (EXACT, JOINED):
        raise ValueError(f"grain is {EXACT!r} or {JOINED!r}, not {grain!r}")
    return grain == JOINED


def _owned(t: Tables, lone: bool = True) -> DataFrame:
    """One row per customer and account; with ``lone``, customers without an
    account appear once."""
    accounts = t["accounts"].select("customer_id", "account_id", "branch_id", "opening_balance")
    customers = t["customers"].select("customer_id")
    if lone:
        return outer_join_many(customers, accounts, "customer_id")
    return accounts.join(customers, "customer_id", "left_semi")


def _loan_counts(t: Tables) -> DataFrame:
    return t["loans"].groupBy("customer_id").agg(m.rows("n_loans"))


def _customers(t: Tables, grain: str) -> DataFrame:
    """Each customer with ``wl``, how often its rows repeat because of loans."""
    customers = t["customers"].select("customer_id")
    if not _repeats(grain):
        return customers.withColumn("wl", F.expr("1L"))
    return customers.join(_loan_counts(t), "customer_id", "left").selectExpr(
        "customer_id", "coalesce(n_loans, 1) AS wl"
    )


def _account_sums(t: Tables, grain: str, scale: int | None, *by: str) -> DataFrame:
    """Accounts and their transactions summed per customer and ``by``.

    ``balance`` and ``known``: balances and how many there are, ``amount`` and
    ``txns``: transactions, ``wt``: rows, with accounts repeated for each of
    their transactions in the joined grain. Transactions are summed per account
    before the join, so a busy account or customer is a handful of rows.
    """
    moves = t["transactions"].groupBy("account_id").agg(
        m.partial("transaction_amount", "amount", scale), m.rows("txns")
    )
    wt = "coalesce(txns, 1)" if _repeats(grain) else "1L"
    accounts = t["accounts"].select("account_id", "customer_id", "branch_id", "opening_balance")
    accounts = accounts.join(moves, "account_id", "left").withColumn("wt", F.expr(wt))
    return accounts.groupBy("customer_id", *by).agg(
        m.weighted("opening_balance", F.col("wt"), scale).alias("balance"),
        F.expr("sum(CASE WHEN opening_balance IS NOT NULL THEN wt END) AS known"),
        m.again("amount", scale).alias("amount"),
        F.sum("txns").alias("txns"),
        F.sum("wt").alias("wt"),
    )


def _move_sums(t: Tables, grain: str, scale: int | None, *by: Column) -> DataFrame:
    """Per customer and group: ``amount``, number of transactions ``txns`` and
    of joined rows ``n``, with the customer's ``wl``."""
    moves = t["transactions"].groupBy("account_id", *by).agg(
        m.partial("transaction_amount", "amount", scale), m.rows("txns")
    )
    names = [c for c in moves.columns if c not in ("account_id", "amount", "txns")]
    how = "left" if _repeats(grain) else "inner"
    owned = t["accounts"].select("account_id", "customer_id").join(moves, "account_id", how)
    per_customer = owned.groupBy("customer_id", *names).agg(
        m.again("amount", scale).alias("amount"), F.sum("txns").alias("txns"), F.expr("sum(coalesce(txns, 1)) AS n")
    )
    return _customers(t, grain).join(per_customer, "customer_id", how)


def _times(column: str, weight: str, scale: int | None) -> Column:
    return m.weighted(column, F.col(weight), scale)


def _moved(t: Tables) -> DataFrame:
    """Accounts with their branch, and their transactions if any."""
    branches = t["branches"].select(
        "branch_id", "branch_name", F.col("city").alias("branch_city"), "branch_state"
    )
    accounts = t["accounts"].select(
        "customer_id",
        "account_id",
        "branch_id",
        "account_type",
        "account_status",
        "opening_balance",
        "account_open_date",
    )
    transactions = t["transactions"].select(
        "account_id",
        "transaction_id",
        "transaction_type",
        "transaction_media",
        "transaction_amount",
        "transaction_date",
    )
    # Branches join while there is still one row per account.
    held = accounts.join(branches, "branch_id", "left")
    return outer_join_many(held, transactions, "account_id")


def _lent(t: Tables) -> DataFrame:
    """Customers, and their loans if any."""
    loans = t["loans"].select(
        "customer_id",
        "loan_id",
        "loan_amount",
        "loan_type",
        "loan_status",
        F.col("branch_id").alias("loan_branch_id"),
    )
    customers = t["customers"].select(
        "customer_id", "first_name", "last_name", "email", "phone_number", "city", "occupation", "dob"
    )
    return outer_join_many(customers, loans, "customer_id")


def master_table(t: Tables) -> DataFrame:
    """The wide table itself: one row per customer, account, transaction and
    loan combination. As large as that sounds; summaries do not need it, and
    :func:`factored` stores the same rows without multiplying them out."""
    lent = _lent(t)
    wide = _moved(t).join(lent, "customer_id", "inner")
    accounts = t["accounts"].select("customer_id").distinct()
    lone = lent.join(accounts, "customer_id", "left_anti")
    return wide.unionByName(lone, allowMissingColumns=True)


#: Rows to a piece of the factored table, about.
PIECE = 1000


def factored(t: Tables, piece: int = PIECE) -> dict[str, DataFrame]:
    """The wide table as two factors, ``moves`` and ``lent``: rows (customer_id, piece, rows), each with
    an array of about ``piece`` rows of one customer. A customer's wide rows are all combinations of
    their two factors, which only :func:`expanded` forms. So the stored size is that of
    the sum of transactions and loans, and a customer with very many is many pieces."""
    moves = t["transactions"].groupBy("account_id").agg(m.rows("n"))
    held = t["accounts"].select("customer_id", "account_id").join(moves, "account_id", "left")
    owned = t["customers"].select("customer_id").join(_loan_counts(t).withColumnRenamed("n_loans", "n"), "customer_id", "left")
    return {"moves": _pieces(_moved(t), held, piece), "lent": _pieces(_lent(t), owned, piece)}


def _pieces(rows: DataFrame, counted: DataFrame, piece: int) -> DataFrame:
    """``counted`` has ``n``, how many children a parent row has: the rows of a customer are
    counted from it, so that the wide join need not be done once more for it."""
    sizes = counted.groupBy("customer_id").agg(F.ceil(F.expr("sum(coalesce(n, 1))") / F.lit(piece)).cast("int").alias("pieces"))
    own = [c for c in rows.columns if c != "customer_id"]
    # Dealt by the row itself: equal rows are there as often as they come, wherever they go.
    dealt = rows.join(sizes, "customer_id").withColumn("piece", F.pmod(F.xxhash64(*own), F.col("pieces")).cast("int"))
    return dealt.groupBy("customer_id", "piece").agg(F.collect_list(F.struct(*own)).alias("rows"))


def expanded(factors: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of :func:`master_table` from its stored factors: pairs of pieces, multiplied out where they are read."""
    moves = factors["moves"].select("customer_id", F.col("rows").alias("_moves"))
    lent = factors["lent"].select("customer_id", F.col("rows").alias("_lent"))
    both = outer_join_many(lent, moves, "customer_id")
    one = both.select("customer_id", "_lent", F.explode_outer("_moves").alias("_move"))
    all_rows = one.select("customer_id", "_move", F.explode("_lent").alias("_loan"))
    return all_rows.select("customer_id", "_move.*", "_loan.*")


def master_fact(t: Tables, grain: str = EXACT) -> DataFrame:
    """The fact columns with every customer kept, even without transactions."""
    moves = t["transactions"].select(
        "account_id", "transaction_id", "transaction_type", "transaction_amount", "transaction_date"
    )
    accounts = t["accounts"].select("customer_id", "account_id", "branch_id")
    customers = _customers(t, grain)
    facts = outer_join_many(accounts, moves, "account_id").join(customers, "customer_id", "inner")
    lone = customers.join(accounts.select("customer_id").distinct(), "customer_id", "left_anti")
    facts = facts.unionByName(lone, allowMissingColumns=True)
    if _repeats(grain):
        facts = facts.withColumn("_repeat", F.expr("explode(sequence(1, wl))"))
    return facts.select(FACT)


def customer_summary(t: Tables, grain: str = EXACT, scale: int | None = None) -> DataFrame:
    sums = _account_sums(t, grain, scale)
    # One row per customer on both sides: the loan weight is a plain factor.
    joined = _customers(t, grain).join(sums, "customer_id", "left")
    return joined.select(
        "customer_id",
        m.times("balance", F.col("wl"), scale).cast("double").alias("total_balance"),
        m.times("amount", F.col("wl"), scale).cast("double").alias("total_transaction_amount"),
        m.ratio(m.times("balance", F.col("wl"), scale), F.expr("known * wl")).alias("avg_balance"),
        F.expr("coalesce(txns, 0) * wl AS transaction_count"),
    )


def branch_performance(t: Tables, grain: str = EXACT, scale: int | None = None) -> DataFrame:
    """By the account's branch. The joined form has a group for customers
    without an account, whose branch is NULL."""
    sums = _account_sums(t, grain, scale, "branch_id")
    joined = _customers(t, grain).join(sums, "customer_id", "left" if _repeats(grain) else "inner")
    return joined.groupBy("branch_id").agg(
        _times("amount", "wl", scale).cast("double").alias("total_amount"),
        F.expr("sum(coalesce(txns, 0) * wl) AS transaction_count"),
        m.ratio(_times("balance", "wl", scale), F.expr("sum(known * wl)")).alias("avg_balance"),
    )


def loan_analysis(t: Tables, grain: str = EXACT, scale: int | None = None) -> DataFrame:
    """The joined form has a NULL type for customers without a loan."""
    lent = t["loans"].groupBy("customer_id", "loan_type").agg(
        m.partial("loan_amount", "lent", scale), m.rows("n"), m.known("loan_amount", "known")
    )
    customers = t["customers"].select("customer_id")
    if _repeats(grain):
        rows = _account_sums(t, grain, scale).select("customer_id", "wt")
        customers = customers.join(rows, "customer_id", "left").selectExpr("customer_id", "coalesce(wt, 1) AS r")
        weighted = customers.join(lent, "customer_id", "left")
    else:
        weighted = lent.join(customers, "customer_id", "left_semi").withColumn("r", F.expr("1L"))
    return weighted.groupBy("loan_type").agg(
        F.expr("sum(coalesce(n, 1) * r) AS total_loans"),
        m.ratio(_times("lent", "r", scale), F.expr("sum(known * r)")).alias("avg_loan_amount"),
    )


def _linked_moves(t: Tables) -> DataFrame:
    """Transactions of the accounts of customers."""
    accounts = t["accounts"].select("account_id", "customer_id")
    accounts = accounts.join(t["customers"].select("customer_id"), "customer_id", "left_semi")
    return t["transactions"].join(accounts.select("account_id"), "account_id", "left_semi")


def transaction_summary(t: Tables, grain: str = EXACT, scale: int | None = None) -> DataFrame:
    """The joined form counts the rows of accounts without transactions under
    the NULL type. In the exact form every weight is 1 and no sums per customer are
    needed; of the customers it reads the keys only."""
    if not _repeats(grain):
        columns = {"total_amount": sums.TOTAL, "transaction_count": sums.ROWS}
        return sums.grouped(_linked_moves(t), ["transaction_type"], "transaction_amount", columns, scale)
    return _move_sums(t, grain, scale, F.col("transaction_type")).groupBy("transaction_type").agg(
        _times("amount", "wl", scale).cast("double").alias("total_amount"),
        F.expr("sum(coalesce(n, 1) * wl) AS transaction_count"),
    )


def monthly_trends(t: Tables, grain: str = EXACT, scale: int | None = None) -> DataFrame:
    months = [F.expr("year(transaction_date) AS year"), F.expr("month(transaction_date) AS month")]
    if not _repeats(grain):
        columns = {"monthly_revenue": sums.TOTAL, "transactions": sums.known("transaction_id")}
        return sums.grouped(_linked_moves(t), months, "transaction_amount", columns, scale)
    return _move_sums(t, grain, scale, *months).groupBy("year", "month").agg(
        _times("amount", "wl", scale).cast("double").alias("monthly_revenue"),
        F.expr("sum(coalesce(txns, 0) * wl) AS transactions"),
    )


def _segment(bands: tuple[float, float]) -> Column:
    high, medium = bands
    balance = F.col("opening_balance")
    return F.when(balance > high, "High Value").when(balance > medium, "Medium Value").otherwise("Low Value")


def customer_segmentation(t: Tables, grain: str = EXACT, bands: tuple[float, float] = BANDS) -> DataFrame:
    """A missing balance counts as low."""
    rows = master_table(t) if _repeats(grain) else _owned(t)
    return rows.withColumn("segment", _segment(bands))


def top_customers(t: Tables, grain: str = EXACT, k: int = TOP) -> DataFrame:
    """The ``k`` rows with the highest balance.

    The joined form ranks wide rows. They can only come from the ``k`` highest
    accounts, and from each at most ``k`` transactions and ``k`` loans.
    """
    best = [F.col("opening_balance").desc_nulls_last(), F.col("account_id").asc_nulls_last(), F.col("customer_id")]
    top = _owned(t).orderBy(*best).limit(k)
    if not _repeats(grain):
        return top

    def first_of(df: DataFrame, key: str, each: str) -> DataFrame:
        near = df.join(F.broadcast(top.select(key)), key, "left_semi")  # k rows
        place = F.row_number().over(Window.partitionBy(key).orderBy(each))
        return near.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")

    few = {
        "customers": t["customers"].join(F.broadcast(top.select("customer_id")), "customer_id", "left_semi"),
        "accounts": t["accounts"].join(F.broadcast(top.select("account_id")), "account_id", "left_semi"),
        "transactions": first_of(t["transactions"], "account_id", "transaction_id"),
        "loans": first_of(t["loans"], "customer_id", "loan_id"),
        "branches": t["branches"],
    }
    ties = [F.col("transaction_id").asc_nulls_last(), F.col("loan_id").asc_nulls_last()]
    return master_table(few).orderBy(*best, *ties).limit(k)


def high_risk_customers(t: Tables, grain: str = EXACT, max_balance: float = LOW_BALANCE) -> DataFrame:
    """Accounts with a low balance whose customer has a loan. The joined form needs of the other
    tables only what belongs to such accounts."""
    if _repeats(grain):
        return master_table(t).filter(_low(max_balance) & F.col("loan_id").isNotNull())
    return _owned(t, lone=False).filter(_low(max_balance)).join(_loan_counts(t), "customer_id")


def _low(max_balance: float) -> Column:
    return F.col("opening_balance") < max_balance


def low_accounts(accounts: DataFrame, max_balance: float = LOW_BALANCE) -> DataFrame:
    return accounts.filter(_low(max_balance))
