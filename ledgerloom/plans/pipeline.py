"""The datasets of the medallion pipeline and a run that stores them in order.

Every dataset is stored once and read back by those after it. A dataset is a
function from the stored inputs to a frame; the functions run no jobs.

Each stored version carries a mark: a digest of what its rows depend on, that is, the marks
of its inputs and the options it uses. A run keeps what has the right mark already, so a
run that was broken off goes on where it stopped, and a changed source or option builds
anew only what depends on it. Datasets that don't wait for each other are built at once.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Collection, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.model import ENTITIES, RELATIONS, Entity
from ledgerloom.operators import integrity, skew
from ledgerloom.plans import bronze, master, risk, silver, star
from ledgerloom.sources.raw import absent_columns, read_raw, source_mark
from ledgerloom.sources.tables import Buckets, current, head, read_table, store

#: Part of every mark: changed whenever the same inputs and options give other rows.
RULES = 3

Tables = Mapping[str, DataFrame]
Lacking = Mapping[str, Collection[str]]


@dataclass(frozen=True)
class Dataset:
    inputs: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    uses: tuple[str, ...] = ()  # the options its rows depend on, apart from those of its inputs


@dataclass(frozen=True)
class Options:
    """``inject`` dirties the source first; ``enforce`` drops orphans before
    gold; ``require_fk`` drops rows without foreign keys; ``exact`` uses exact
    quantiles; ``scale`` sums money exactly with that many decimals; ``grain``
    is that of the master summaries; ``split_hot_keys`` counts heavy foreign
    keys and deals their rows onto slices in the integrity and fact joins."""

    inject: bool = False
    seed: int = 0
    enforce: bool = True
    require_fk: bool = True
    exact: bool = False
    scale: int | None = None
    grain: str = master.EXACT
    split_hot_keys: bool = False
    buckets: int = 0


#: The key that the other side of a table's joins has, too.
_BUCKET_KEYS = {"accounts": "account_id", "transactions": "account_id", "customers": "customer_id", "loans": "customer_id"}


#: Datasets that are stored in the order in which they are read.
ORDERS = {
    "kpi_top_customers": ("-total_spent", "customer_id"),
    "kpi_branch_performance": ("-branch_revenue", "branch_id"),
    "kpi_customer_branch": ("-total_amount", "customer_id", "branch_id"),
    "kpi_monthly_trend": ("month",),
}


def bucket_key(dataset: str) -> str | None:
    layer, _, entity = dataset.partition("_")
    return _BUCKET_KEYS.get(entity) if layer in ("silver", "marked", "kept", "dim", "fact") else None


def _bronze(entity: Entity, o: Options, t: Tables) -> DataFrame:
    source = t[f"source_{entity.name}"]
    if not o.inject:
        return source
    row_id = F.md5(F.to_json(F.struct(*entity.columns)))
    return bronze.bronze(source, entity, row_id, o.seed)


def _silver(entity: Entity, o: Options, lacking: Lacking, t: Tables) -> DataFrame:
    optional = lacking.get(entity.name, ())
    return silver.clean(t[f"bronze_{entity.name}"], entity, o.require_fk, optional_fks=optional, exact=o.exact)


def _hot(entity: Entity, fk: str, t: Tables) -> DataFrame:
    # A hundredth of the rows shows every key heavy enough to matter.
    return skew.hot_keys(t[f"silver_{entity.name}"], fk, probe=100, by=(entity.key,))


def _marked(entity: Entity, lacking: Lacking, t: Tables) -> DataFrame:
    parents = {p: t[f"{'marked' if ENTITIES[p].foreign_keys else 'silver'}_{p}"] for p in entity.parents.values()}
    hot = {fk: t.get(f"hot_{entity.name}_{fk}") for fk in entity.foreign_keys}
    return integrity.marked(t[f"silver_{entity.name}"], entity, parents, hot, lacking.get(entity.name, ()))


def _kept(name: str, o: Options, t: Tables) -> DataFrame:
    return integrity.unbroken(t[f"marked_{name}"]) if o.enforce else t[f"silver_{name}"]


def _fact(t: Tables) -> DataFrame:
    return star.fact_transactions(t["silver_transactions"], t["kept_accounts"], t.get("hot_transactions_account_id"))


def _gold_tables(t: Tables) -> dict[str, DataFrame]:
    return {name: t[f"{'kept' if e.foreign_keys else 'silver'}_{name}"] for name, e in ENTITIES.items()}


def _rules(lacking: Lacking) -> list[tuple[str, str, str]]:
    return [r for r in RELATIONS if r[1] not in lacking.get(r[0], ())]


def _report(lacking: Lacking, t: Tables) -> DataFrame:
    return integrity.marked_report({child: t[f"marked_{child}"] for child, _, _ in RELATIONS}, _rules(lacking))


def _report_after(lacking: Lacking, t: Tables) -> DataFrame:
    """Counted anew from the stored tables, not taken from the marks."""
    return integrity.ri_report(_gold_tables(t), _rules(lacking))


def datasets(options: Options = Options(), lacking: Lacking | None = None) -> dict[str, Dataset]:
    """All datasets by name, each after its inputs. ``lacking`` names, by entity, the
    columns that its source does not have; a foreign key among them is no rule."""
    o, lacking = options, lacking or {}
    found: dict[str, Dataset] = {}
    for name, entity in ENTITIES.items():
        found[f"bronze_{name}"] = Dataset((f"source_{name}",), partial(_bronze, entity, o), ("inject", "seed"))
    for name, entity in ENTITIES.items():
        found[f"silver_{name}"] = Dataset((f"bronze_{name}",), partial(_silver, entity, o, lacking), ("require_fk", "exact"))
    children = [name for name, entity in ENTITIES.items() if entity.foreign_keys]
    if o.split_hot_keys:
        # Stored, so that the two sides of a join are dealt by the same keys.
        for name in children:
            for fk in ENTITIES[name].foreign_keys:
                found[f"hot_{name}_{fk}"] = Dataset((f"silver_{name}",), partial(_hot, ENTITIES[name], fk))
    for name in children:
        parents = [p for child, _, p in RELATIONS if child == name]
        inputs = [f"{'marked' if ENTITIES[p].foreign_keys else 'silver'}_{p}" for p in parents]
        inputs += [f"hot_{name}_{fk}" for fk in ENTITIES[name].foreign_keys if o.split_hot_keys]
        found[f"marked_{name}"] = Dataset((f"silver_{name}", *inputs), partial(_marked, ENTITIES[name], lacking))
        source = f"{'marked' if o.enforce else 'silver'}_{name}"
        found[f"kept_{name}"] = Dataset((source,), partial(_kept, name, o), ("enforce",))
    found["ri_report"] = Dataset(tuple(f"marked_{name}" for name in children), partial(_report, lacking))
    gold = tuple(f"{'kept' if e.foreign_keys else 'silver'}_{name}" for name, e in ENTITIES.items())
    found["ri_report_after"] = Dataset(gold, partial(_report_after, lacking))

    def on(source: str, plan, **extra) -> Dataset:
        return Dataset((source,), lambda t: plan(t[source], **extra), tuple(extra))

    found["dim_customers"] = on("silver_customers", star.dim_customers)
    found["dim_branches"] = on("silver_branches", star.dim_branches)
    found["dim_accounts"] = on("kept_accounts", star.dim_accounts)
    hot = ("hot_transactions_account_id",) if o.split_hot_keys else ()
    found["fact_transactions"] = Dataset(("silver_transactions", "kept_accounts", *hot), _fact)

    fact = "fact_transactions"
    for plan in (
        star.kpi_total_business,
        star.kpi_transaction_type,
        star.kpi_top_customers,
        star.kpi_branch_performance,
        star.kpi_monthly_trend,
        star.kpi_customer_branch,
        risk.customer_risk_score,
    ):
        found[plan.__name__] = on(fact, plan, scale=o.scale)
    found["kpi_account_type"] = Dataset(
        (fact, "dim_accounts"), lambda t: star.kpi_account_type(t[fact], t["dim_accounts"], o.scale), ("scale",)
    )
    found["kpi_high_value_txn"] = on(fact, star.kpi_high_value_txn, exact=o.exact)

    for name, plan in {
        "master_customer_summary": master.customer_summary,
        "master_branch_performance": master.branch_performance,
        "master_loan_analysis": master.loan_analysis,
        "master_transaction_summary": master.transaction_summary,
        "monthly_trends": master.monthly_trends,
    }.items():
        found[name] = Dataset(gold, lambda t, plan=plan: plan(_gold_tables(t), o.grain, o.scale), ("grain", "scale"))
    for plan in (
        master.master_fact,
        master.customer_segmentation,
        master.top_customers,
        master.high_risk_customers,
    ):
        found[plan.__name__] = Dataset(gold, lambda t, plan=plan: plan(_gold_tables(t), o.grain), ("grain",))
    # As large as its rows: every combination of a customer's transactions and loans.
    found["master_table"] = Dataset(gold, lambda t: master.master_table(_gold_tables(t)))
    # The same rows unmultiplied; ``master.expanded`` reads them.
    for name in ("moves", "lent"):
        found[f"master_{name}"] = Dataset(gold, lambda t, name=name: master.factored(_gold_tables(t))[name])
    return found


def read_sources(spark: SparkSession, path: str, globs: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """The five raw entities from CSV files under ``path``."""
    return {f"source_{name}": read_raw(spark, e, path, (globs or {}).get(name)) for name, e in ENTITIES.items()}


def run(
    sources: Tables,
    target: str,
    options: Options = Options(),
    fmt: str = "parquet",
    only: set[str] | None = None,
    resume: bool = True,
    at_once: int = 4,
) -> dict[str, DataFrame]:
    """Build and store the datasets, or those in ``only`` and what they need.

    ``sources`` holds ``source_<entity>`` frames. ``target`` is a folder, or a
    database name to store catalog tables. Returns the stored frames. A foreign
    key that no file of a source has does not drop its rows.

    With ``resume``, datasets that are stored with the right mark are kept. The mark of a source read by
    :func:`read_sources` is that of its files; any other source is read through once for it.
    Up to ``at_once`` datasets are built at the same time. If one fails, those at work are finished, and
    the error is raised.
    """
    given = {name: f for name, f in sources.items() if name.startswith("source_")}
    lacking = {name: absent_columns(given[f"source_{name}"]) for name in ENTITIES if f"source_{name}" in given}
    plan = datasets(options, lacking)
    wanted = _closure(plan, only or set(plan))
    roots = {i for name in wanted for i in plan[name].inputs if i not in plan}
    marks = {name: source_mark(sources[name]) for name in roots} if resume else {}
    for name, dataset in plan.items():
        if resume and name in wanted:
            marks[name] = _mark(name, dataset, options, lacking, fmt, marks)

    def made(name: str, inputs: Tables) -> DataFrame:
        place = f"{target.rstrip('/')}/{name}" if "/" in target else f"{target}.{name}"
        spark = next(iter(inputs.values())).sparkSession
        if resume and (held := current(spark, place)) and held.mark == marks[name]:
            return read_table(spark, place, fmt)
        key = bucket_key(name) if options.buckets and "/" not in target else None
        buckets = Buckets(options.buckets, key) if key else None
        return store(plan[name].build(inputs), place, fmt, marks.get(name), buckets=buckets, order=ORDERS.get(name, ()))

    tables = dict(sources)
    waiting = [name for name in plan if name in wanted]
    with ThreadPoolExecutor(at_once) as pool:
        working: dict = {}
        while waiting or working:
            for name in [n for n in waiting if all(i in tables for i in plan[n].inputs)]:
                waiting.remove(name)
                working[pool.submit(made, name, dict(tables))] = name
            if not working:
                raise KeyError(f"no source for {waiting[0]}")
            for done in wait(working, return_when=FIRST_COMPLETED).done:
                name = working.pop(done)
                if done.exception():
                    pool.shutdown(cancel_futures=True)
                tables[name] = done.result()
    return {name: tables[name] for name in wanted}


def _mark(name: str, dataset: Dataset, options: Options, lacking: Lacking, fmt: str, marks: Mapping[str, str]) -> str:
    told = {
        "rules": RULES,
        "dataset": name,
        "stored": [fmt, options.buckets],
        "options": {o: getattr(options, o) for o in dataset.uses},
        "lacking": sorted((e, sorted(c)) for e, c in lacking.items() if c),
        "inputs": [marks[i] for i in dataset.inputs],
    }
    return hashlib.sha256(json.dumps(told, sort_keys=True).encode()).hexdigest()


def top(spark: SparkSession, target: str, name: str, k: int) -> DataFrame:
    """The first ``k`` rows of one of the ``ORDERS``, from the first files of the stored dataset."""
    return head(spark, f"{target.rstrip('/')}/{name}" if "/" in target else f"{target}.{name}", k)


def _closure(plan: Mapping[str, Dataset], names: set[str]) -> set[str]:
    needed: set[str] = set()
    waiting = [n for n in names]
    while waiting:
        name = waiting.pop()
        if name in plan and name not in needed:
            needed.add(name)
            waiting += plan[name].inputs
    return needed
