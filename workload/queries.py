"""Every operator as a query over the driver tables.

Money in the driver tables has two decimals, so sums are exact (``scale=2``)
and quantiles are exact too: results do not depend on partitioning.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.model import AUDIT_COLUMN, ENTITIES
from ledgerloom.operators import integrity, quantile, sketches, skew
from ledgerloom.plans import bronze, master, pipeline, risk, silver, star
from ledgerloom.session import configure
from ledgerloom.sources.raw import read_raw
from ledgerloom.sources.scratch import scratch_dir, stage, stage_all
from ledgerloom.sources.tables import head, store
from workload.raw import CLEAN, NUMERIC, PREFER, RAW, driver_table, frame

SCALE = 2
SEED = 11
LOADED = "2024-05-06 07:08:09"  # the clock of the rows that carry a time of loading


class Tables(Mapping):
    """Named frames, each planned when it is first asked for."""

    def __init__(self, make: Callable[[str], DataFrame]):
        self._make, self._made = make, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in ENTITIES:
            raise KeyError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def knows(self, name: str) -> bool:
        return name in self._made

    def add(self, frames: Mapping[str, DataFrame]) -> Tables:
        """Take frames that were made together."""
        self._made |= frames
        return self

    def __iter__(self):
        return iter(ENTITIES)

    def __len__(self) -> int:
        return len(ENTITIES)


class Bank:
    """The banking tables of one directory, as lazy frames.

    ``silver`` are the cleaned tables, ``kept`` those after integrity
    enforcement, which the star schema and the master analytics read.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, exact: bool = True):
        self.exact = exact
        self._runs: dict[str, DataFrame] | None = None
        self.driver = cache(lambda table: driver_table(spark, sf_dir, table))
        self.raw = Tables(lambda name: frame(spark, self.driver, RAW[name]))
        self.source = Tables(lambda name: frame(spark, self.driver, CLEAN[name]))
        self.silver = Tables(self._clean)
        self.parents = Tables(self._parent)
        self.kept = Tables(self._keep)
        # For plans that reach transactions through enforced accounts only: the
        # join drops orphaned transactions, so they need not be dropped before.
        self.linked = Tables(lambda name: (self.silver if name == "transactions" else self.kept)[name])
        self.keyed = Tables(lambda name: self.linked[name] if ENTITIES[name].foreign_keys else self.parents[name])
        self.marked = Tables(self._mark)
        # The same of the keys only, for plans that count.
        self.marks = Tables(self._mark_keys)
        # The same as stored tables, for plans that read a table more than once.
        self.stored = Tables(lambda name: stage(self.linked[name], name))

    def _clean(self, name: str, rows: DataFrame | None = None) -> DataFrame:
        return silver.clean(
            self.raw[name], ENTITIES[name], exact=self.exact, prefer=PREFER.get(name, ()), audit=False, rows=rows
        )

    def _parent(self, name: str) -> DataFrame:
        """A table for key lookups: plain parents need not be cleaned for it."""
        entity = ENTITIES[name]
        return self.silver[name] if entity.foreign_keys else silver.known_keys(self.raw[name], entity)

    def _keep(self, name: str) -> DataFrame:
        entity = ENTITIES[name]
        parents = {p: self.kept[p] if ENTITIES[p].foreign_keys else self.parents[p] for p in entity.parents.values()}
        return integrity.enforce_entity(self.silver[name], entity, parents)

    def _mark(self, name: str) -> DataFrame:
        entity = ENTITIES[name]
        parents = {p: self.marked[p] if ENTITIES[p].foreign_keys else self.parents[p].distinct() for p in entity.parents.values()}
        return stage(integrity.marked(self.silver[name], entity, parents), f"marked_{name}")

    def _mark_keys(self, name: str) -> DataFrame:
        entity = ENTITIES[name]
        rows = self.silver[name].select(entity.key, *entity.foreign_keys)
        parents = {p: self.marks[p] if ENTITIES[p].foreign_keys else self.parents[p].distinct() for p in entity.parents.values()}
        marks = integrity.marked(rows, entity, parents).select(entity.key, integrity.BROKEN)
        read_twice = any(name in other.parents.values() for other in ENTITIES.values())
        return stage(marks, f"marks_{name}") if read_twice else marks

    def held(self, *names: str) -> Tables:
        """The stored tables. Those of ``names`` (all, if none are given) that are not stored yet are stored at once."""
        missing = {n: self.linked[n] for n in names or ENTITIES if not self.stored.knows(n)}
        return self.stored.add(stage_all(missing))

    @cached_property
    def fact(self) -> DataFrame:
        return star.fact_transactions(self.linked["transactions"], self.linked["accounts"])

    @cached_property
    def fact_sliced(self) -> DataFrame:
        raw_keys = silver.idents(self.raw["transactions"], "account_id")
        hot = stage(skew.hot_keys(raw_keys, "account_id"), "hot_keys")
        return star.fact_transactions(self.silver["transactions"], self.kept["accounts"], hot)

    @cached_property
    def stored_fact(self) -> DataFrame:
        """The fact as a stored table, for plans that read it more than once."""
        return stage(self.fact, "fact")

    @cached_property
    def stored_amounts(self) -> DataFrame:
        """Keys and amounts of the fact as a stored table. Where the fact is not stored, its other columns
        are neither joined nor written."""
        if "stored_fact" in self.__dict__:
            return self.stored_fact.select("transaction_id", "transaction_amount")
        return stage(self.fact.select("transaction_id", "transaction_amount"), "fact_amounts")

    @cached_property
    def loan_rows(self) -> DataFrame:
        return self.raw["loans"].select("customer_id", "loan_type", F.col("loan_amount").try_cast("double").alias("loan_amount"))

    @cached_property
    def fact_sketches(self) -> DataFrame:
        """Sketches of the amounts, one for each transaction type, as a stored table. Their one pass needs
        no stored fact: where there is none, the fact's other columns are neither joined nor written."""
        fact = self.__dict__.get("stored_fact", self.fact)
        return stage(sketches.sketch(fact, "transaction_amount", "transaction_type"), "fact_sketches")

    def stored_top(self, name: str, plan: Callable[..., DataFrame], k: int) -> DataFrame:
        """The first rows of a KPI that is stored in order."""
        spark = self.fact.sparkSession
        path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
        store(plan(self.fact, scale=SCALE), path, order=pipeline.ORDERS[name])
        return head(spark, path, k)

    def run(self, name: str) -> DataFrame:
        """A dataset by way of a pipeline run over the raw tables."""
        if self._runs is None:
            sources = {f"source_{n}": self.raw[n].select(e.columns) for n, e in ENTITIES.items()}
            target = f"{scratch_dir(self.raw['accounts'].sparkSession)}/run-{uuid.uuid4().hex}"
            options = pipeline.Options(exact=self.exact, scale=SCALE)
            self._runs = pipeline.run(sources, target, options, only={"dim_accounts", "kept_loans", "ri_report_after"}, resume=False)
        return self._runs[name].drop(AUDIT_COLUMN)

    @cached_property
    def risky(self) -> dict[str, DataFrame]:
        """The stored tables, cut to accounts with a low balance, their transactions and the loans of their customers."""
        low = stage(master.low_accounts(self.kept["accounts"]), "low_accounts")
        keys = {"transactions": low.select("account_id"), "loans": low.select("customer_id").distinct()}
        # A file of keys has a known size, so Spark broadcasts it where it is small. All copies of a key
        # are cleaned that has one with a wanted account: which copy stays is told by all of them.
        hits = stage_all({n: silver.keys_with(self.raw[n], ENTITIES[n], k) for n, k in keys.items()})
        cut = {
            n: self._clean(n, silver.of_keys(self.raw[n], ENTITIES[n], hits[n])).join(k, k.columns, "left_semi")
            for n, k in keys.items()
        }
        cut["loans"] = integrity.enforce_entity(cut["loans"], ENTITIES["loans"], self.parents)
        rest = {n: self.linked[n] for n in ("customers", "branches")}
        return {"accounts": low, **stage_all(cut | rest)}

    @cached_property
    def stored_factors(self) -> dict[str, DataFrame]:
        return stage_all(master.factored(self.held()))

    @cached_property
    def stored_sums(self) -> DataFrame:
        return stage(risk.customer_sums(self.fact, SCALE), "customer_sums")

    @cached_property
    def from_csv(self) -> DataFrame:
        """Accounts read back from CSV files whose headers differ in order, case, names and
        padding, from folders with names of all sorts."""
        raw, path = self.raw["accounts"], f"{scratch_dir(self.raw['accounts'].sparkSession)}/csv"
        columns = ENTITIES["accounts"].columns
        odd = F.pmod(F.xxhash64(*columns), F.lit(2)) == 1
        other = [F.col(c).alias({"opening_balance": "BALANCE", "account_type": " Account_Type "}.get(c, c.upper())) for c in reversed(columns)]
        raw.where(odd).select(*columns).write.option("header", True).csv(f"{path}/odd 100%20 [1]", mode="overwrite")
        raw.where(~odd | odd.isNull()).select(*other).write.option("header", True).csv(f"{path}/even {{2}}", mode="overwrite")
        return read_raw(raw.sparkSession, ENTITIES["accounts"], f"{path}/*", glob="*.csv")

    def dirty(self, name: str) -> DataFrame:
        return bronze.bronze(self.source[name], ENTITIES[name], F.col("row_id"), SEED, NUMERIC.get(name, ()))


def _bronze_steps(b: Bank) -> dict[str, Callable[[], DataFrame]]:
    columns = ENTITIES["accounts"].columns
    text = [c for c in columns if c not in NUMERIC["accounts"]]

    def row() -> Column:
        return F.col("row_id")

    def source() -> DataFrame:
        return b.source["accounts"]

    def holes() -> DataFrame:
        return bronze.inject_nulls(source(), columns, row(), seed=SEED)

    return {
        "b_nulls": holes,
        "b_duplicates": lambda: bronze.inject_duplicates(source(), row(), seed=SEED),
        "b_blanks": lambda: bronze.nulls_to_blank(holes(), text),
        "b_case_noise": lambda: bronze.inject_case_noise(source(), text, row(), SEED),
    }


def _catalog(b: Bank) -> dict[str, Callable[[], DataFrame]]:
    """Query name to a thunk that builds its plan."""
    plans: dict[str, Callable[[], DataFrame]] = dict(_bronze_steps(b))
    for name in ENTITIES:
        plans[f"b_{name}"] = lambda name=name: b.dirty(name)
        plans[f"s_{name}"] = lambda name=name: b.silver[name]

    plans["impute_median"] = lambda: quantile.impute_median(
        b.raw["loans"].select("customer_id", "loan_type", F.col("loan_amount").try_cast("double").alias("loan_amount")),
        "loan_amount",
        exact=b.exact,
    )

    # The report alone is cheaper by keys that are counted before the joins.
    plans["ri_report"] = lambda: integrity.ri_report(b.parents)
    # Every child is marked by one join for each relation; these are projections of the marks.
    plans["ri_report_marked"] = lambda: integrity.marked_report(b.marks)
    plans["ri_report_after"] = lambda: integrity.ri_report(
        {name: b.kept[name] if ENTITIES[name].foreign_keys else b.parents[name] for name in ENTITIES}
    )
    plans["ri_orphans"] = lambda: integrity.marked_orphans(b.marked["transactions"], ENTITIES["transactions"], "account_id")
    for name in ("accounts", "loans", "transactions"):
        plans[f"ri_{name}_clean"] = lambda name=name: integrity.unbroken(b.marked[name])

    plans["dim_customers"] = lambda: star.dim_customers(b.kept["customers"])
    plans["dim_branches"] = lambda: star.dim_branches(b.kept["branches"])
    plans["dim_accounts"] = lambda: star.dim_accounts(b.kept["accounts"])
    plans["fact_transactions"] = lambda: b.fact
    plans["fact_transactions_sliced"] = lambda: b.fact_sliced

    plans["kpi_total_business"] = lambda: star.kpi_total_business(b.fact, scale=SCALE)
    plans["kpi_transaction_type"] = lambda: star.kpi_transaction_type(b.fact, scale=SCALE)
    plans["kpi_top_customers"] = lambda: star.kpi_top_customers(b.fact, scale=SCALE)
    plans["kpi_branch_performance"] = lambda: star.kpi_branch_performance(b.fact, scale=SCALE)
    plans["kpi_monthly_trend"] = lambda: star.kpi_monthly_trend(b.fact, scale=SCALE)
    plans["kpi_account_type"] = lambda: star.kpi_account_type(b.fact, b.kept["accounts"], scale=SCALE)
    plans["kpi_customer_branch"] = lambda: star.kpi_customer_branch(b.fact, scale=SCALE)
    plans["kpi_high_value_txn"] = lambda: star.kpi_high_value_txn(b.stored_fact, exact=b.exact)
    plans["customer_risk_score"] = lambda: risk.score(b.stored_sums)
    plans["csv_accounts"] = lambda: silver.clean(b.from_csv, ENTITIES["accounts"], exact=b.exact, audit=False)
    plans["kpi_top_customers_10"] = lambda: star.kpi_top_customers(b.fact, k=10, scale=SCALE)
    plans["kpi_top_customers_stored_10"] = lambda: b.stored_top("kpi_top_customers", star.kpi_top_customers, 10)
    plans["kpi_customer_branch_stored_10"] = lambda: b.stored_top("kpi_customer_branch", star.kpi_customer_branch, 10)
    plans["kpi_customer_branch_10"] = lambda: star.kpi_customer_branch(b.fact, k=10, scale=SCALE)
    plans["kpi_branch_performance_ordered"] = lambda: star.kpi_branch_performance(b.fact, order=True, scale=SCALE)
    plans["kpi_monthly_trend_ordered"] = lambda: star.kpi_monthly_trend(b.fact, True, exclude_sentinel=True, scale=SCALE)
    plans["kpi_high_value_txn_sketch"] = lambda: star.kpi_high_value_txn(b.stored_fact, sketch=b.fact_sketches)
    plans["kpi_high_value_txn_certificate"] = lambda: sketches.certified(b.fact_sketches, 0.9)
    plans["impute_median_sketch"] = lambda: quantile.impute_median(
        b.loan_rows, "loan_amount", sketch=stage(sketches.sketch(b.loan_rows, "loan_amount"), "loan_sketch")
    )
    plans["kpi_high_value_txn_default"] = lambda: _placed(
        b.stored_amounts, star.kpi_high_value_txn(b.stored_amounts), "transaction_id", "transaction_amount", 0.9
    )
    plans["impute_median_default"] = lambda: _imputed(
        b.raw["loans"].select("loan_id", F.col("loan_amount").try_cast("double").alias("loan_amount")), "loan_amount"
    )
    plans["s_branches_loaded"] = lambda: silver.clean(
        b.raw["branches"], ENTITIES["branches"], prefer=PREFER["branches"], audit=F.expr(f"TIMESTAMP '{LOADED}'")
    )
    doubles = {
        "kpi_total_business": star.kpi_total_business,
        "kpi_transaction_type": star.kpi_transaction_type,
        "kpi_top_customers": star.kpi_top_customers,
        "kpi_branch_performance": star.kpi_branch_performance,
        "kpi_monthly_trend": star.kpi_monthly_trend,
        "kpi_customer_branch": star.kpi_customer_branch,
        "customer_sums": risk.customer_sums,
    }
    for name, plan in doubles.items():
        plans[f"{name}_doubles"] = lambda plan=plan: plan(b.fact)
    plans["kpi_account_type_doubles"] = lambda: star.kpi_account_type(b.fact, b.kept["accounts"])
    plans["master_transaction_summary_doubles"] = lambda: master.transaction_summary(b.keyed)
    plans["monthly_trends_doubles"] = lambda: master.monthly_trends(b.keyed)
    for name in ("dim_accounts", "kept_loans", "ri_report_after"):
        plans[f"run_{name}"] = lambda name=name: b.run(name)

    plans["master_table"] = lambda: master.master_table(b.held())
    plans["master_table_expanded"] = lambda: master.expanded(b.stored_factors)
    summed = {
        "master_customer_summary": master.customer_summary,
        "master_branch_performance": master.branch_performance,
        "master_loan_analysis": master.loan_analysis,
        "master_transaction_summary": master.transaction_summary,
        "monthly_trends": master.monthly_trends,
    }
    by_row = {
        "master_fact": master.master_fact,
        "customer_segmentation": master.customer_segmentation,
        "top_customers": master.top_customers,
        "high_risk_customers": master.high_risk_customers,
    }
    for grain, suffix in ((master.EXACT, ""), (master.JOINED, "_joined")):
        for name, plan in summed.items():
            # Of the customers, these two need the keys only.
            by_key = grain == master.EXACT and name in ("master_transaction_summary", "monthly_trends")
            tables = b.keyed if by_key else b.linked
            plans[name + suffix] = lambda plan=plan, grain=grain, tables=tables: plan(tables, grain, scale=SCALE)
        for name, plan in by_row.items():
            # Plans that read a table more than once get stored tables.
            if grain == master.EXACT:
                read = (lambda: b.held("customers", "accounts", "transactions")) if name == "master_fact" else (lambda: b.linked)
            elif name == "high_risk_customers":
                read = lambda: b.risky
            else:
                read = b.held if name != "master_fact" else lambda: b.held("customers", "accounts", "transactions", "loans")
            plans[name + suffix] = lambda plan=plan, grain=grain, read=read: plan(read(), grain)
    return plans


def _near(df: DataFrame, column: str, p: float) -> tuple[Column, Column]:
    """The values a rank error below and above the quantile."""
    off = (max(0.0, p - quantile.ERROR), min(1.0, p + quantile.ERROR))
    return tuple(quantile.quantile(df, column, q, exact=True).scalar() for q in off)


def _placed(df: DataFrame, kept: DataFrame, key: str, column: str, p: float) -> DataFrame:
    """All rows with whether the plan ``kept`` them; 'either' where the rank error of the sketch leaves it open."""
    low, high = _near(df, column, p)
    open_ = (F.col(column) >= F.col("low")) & (F.col(column) < F.col("high"))
    marked = df.join(kept.select(key, F.lit(True).alias("has")), key, "left").withColumns({"low": low, "high": high})
    return marked.select(key, column, F.when(open_, "either").when(F.col("has"), "in").otherwise("out").alias("place"))


def _imputed(df: DataFrame, column: str) -> DataFrame:
    """The imputed column; of the rows that had no value, whether theirs is within the rank error."""
    low, high = _near(df, column, 0.5)
    filled = quantile.impute_median(df.withColumn("given", F.col(column)), column).withColumns({"low": low, "high": high})
    within = F.when(F.col("given").isNull(), F.col(column).between(F.col("low"), F.col("high")))
    return filled.select("loan_id", F.col("given").alias(column), within.alias("within_error"))


_banks: dict[tuple, Bank] = {}


def _bank(spark: SparkSession, sf_dir: str, exact: bool) -> Bank:
    """One for each folder of an application, so its stored tables are written once."""
    key = (spark.sparkContext.applicationId, sf_dir, exact)
    if key not in _banks:
        _banks[key] = Bank(spark, sf_dir, exact)
    return _banks[key]


def forget() -> None:
    """Let the next queries store their tables anew."""
    _banks.clear()


def _query(name: str, exact: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _catalog(_bank(configure(spark), sf_dir, exact))[name]()

    run.__name__ = name
    return run


def queries(exact: bool = True) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """``exact`` quantiles agree with SQL to the row; the library's default is
    a sketch with rank error 1/10,000."""
    return {name: _query(name, exact) for name in _names()}


def _names() -> list[str]:
    return list(_catalog(Bank(None, "")))
