"""Referential integrity between the cleaned entities.

The work is done once, by :func:`marked`: one join for each foreign key adds to every child row
what is wrong with it. The report, the orphans and the rows that stay are projections of that.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.model import ENTITIES, RELATIONS, Entity
from ledgerloom.operators.skew import parent_join

Tables = Mapping[str, DataFrame]

#: What is wrong with a row, two bits for each foreign key in the entity's order: it has no parent,
#: or its parent has something wrong itself.
BROKEN = "_broken"
_NO_PARENT, _BROKEN_PARENT = 1, 2


def orphans(
    child: DataFrame, parent: DataFrame, key: str, hot: DataFrame | None = None, spread: tuple[str, ...] = ()
) -> DataFrame:
    """Child rows without a parent; a NULL key has none."""
    return parent_join(child, parent.select(key), key, "left_anti", hot, spread)


def enforce_fk(
    child: DataFrame, parent: DataFrame, key: str, hot: DataFrame | None = None, spread: tuple[str, ...] = ()
) -> DataFrame:
    """Child rows that have a parent."""
    return parent_join(child, parent.select(key), key, "left_semi", hot, spread)


def count_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row ``orphans``. Child rows are counted per key before the join, so
    the join sees each key once however many rows it has."""
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = per_key.join(parent.select(key), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphans"))


def ri_report(tables: Tables, relations: Sequence[tuple[str, str, str]] = RELATIONS) -> DataFrame:
    """(check, orphans, ok) for every relation, in one frame and one action. A child's
    foreign keys are counted in one pass over its rows, each key once."""
    checks = []
    for child in dict.fromkeys(child for child, _, _ in relations):
        own = {fk: parent for name, fk, parent in relations if name == child}
        checks.append(_child_report(child, tables[child], {fk: (p, tables[p]) for fk, p in own.items()}))
    return reduce(DataFrame.unionAll, checks)


def _child_report(name: str, child: DataFrame, parents: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    pairs = ", ".join(f"'{fk}', {fk}" for fk in parents)
    per_key = child.selectExpr(f"stack({len(parents)}, {pairs}) AS (fk, k)").groupBy("fk", "k").agg(F.count(F.lit(1)).alias("n"))
    known = reduce(
        DataFrame.unionAll,
        (p.select(F.lit(fk).alias("fk"), F.col(_parent_key(parent)).alias("k")) for fk, (parent, p) in parents.items()),
    )
    missing = per_key.join(known, ["fk", "k"], "left_anti").groupBy("fk").agg(F.sum("n").alias("n"))
    named = ", ".join(f"'{fk}', '{name}.{fk} -> {parent}'" for fk, (parent, _) in parents.items())
    listed = child.sparkSession.range(1).selectExpr(f"stack({len(parents)}, {named}) AS (fk, check)")
    orphans = F.coalesce("n", F.lit(0)).cast("bigint")
    return listed.join(missing, "fk", "left").select("check", orphans.alias("orphans"), (orphans == 0).alias("ok"))


def marked(
    child: DataFrame,
    entity: Entity,
    parents: Tables,
    hot: Mapping[str, DataFrame | None] | None = None,
    optional_fks: Collection[str] = (),
) -> DataFrame:
    """``child`` with the column ``_broken``. ``parents`` are unique in their keys; those that are
    marked themselves pass on what is wrong with them. ``optional_fks`` are no rules."""
    columns = list(child.columns)
    told = F.lit(0)
    for place, (fk, name) in enumerate(entity.parents.items()):
        if fk in optional_fks:
            continue
        parent, state = parents[name], f"_{fk}_state"
        wrong = F.when(F.col(BROKEN) > 0, _BROKEN_PARENT).otherwise(0) if BROKEN in parent.columns else F.lit(0)
        side = parent.select(F.col(_parent_key(name)).alias(fk), wrong.alias(state))
        child = parent_join(child, side, fk, "left", (hot or {}).get(fk), (entity.key,))
        told = told.bitwiseOR(F.shiftleft(F.coalesce(state, F.lit(_NO_PARENT)), 2 * place))
    return child.select(*columns, told.cast("int").alias(BROKEN))


def _bit(entity: Entity, fk: str) -> int:
    return _NO_PARENT << 2 * entity.foreign_keys.index(fk)


def marked_report(tables: Tables, relations: Sequence[tuple[str, str, str]] = RELATIONS) -> DataFrame:
    """As :func:`ri_report`, from marked children: one aggregate for each of them, no join."""
    checks = []
    for child in dict.fromkeys(child for child, _, _ in relations):
        own = {fk: parent for name, fk, parent in relations if name == child}
        bits = [F.count_if(F.col(BROKEN).bitwiseAND(F.lit(_bit(ENTITIES[child], fk))) > 0).alias(fk) for fk in own]
        named = ", ".join(f"'{child}.{fk} -> {parent}', {fk}" for fk, parent in own.items())
        checks.append(tables[child].agg(*bits).selectExpr(f"stack({len(own)}, {named}) AS (check, orphans)"))
    return reduce(DataFrame.unionAll, checks).withColumn("ok", F.col("orphans") == 0)


def marked_orphans(child: DataFrame, entity: Entity, fk: str) -> DataFrame:
    """The rows of a marked child that have no parent by ``fk``."""
    return child.where(F.col(BROKEN).bitwiseAND(F.lit(_bit(entity, fk))) > 0).drop(BROKEN)


def unbroken(child: DataFrame) -> DataFrame:
    """The rows of a marked child that have all their parents, and these all theirs."""
    return child.where(F.col(BROKEN) == 0).drop(BROKEN)


def _parent_key(name: str) -> str:
    return ENTITIES[name].key


def enforce_entity(
    child: DataFrame,
    entity: Entity,
    parents: Tables,
    hot: Mapping[str, DataFrame | None] | None = None,
    optional_fks: Collection[str] = (),
) -> DataFrame:
    """Rows of one entity that have all their parents, but for ``optional_fks``.

    ``hot`` may give, per foreign key, the heavy keys to slice.
    """
    for fk, parent in entity.parents.items():
        if fk in optional_fks:
            continue
        child = enforce_fk(child, parents[parent], fk, (hot or {}).get(fk), (entity.key,))
    return child


def enforce_integrity(tables: Tables) -> dict[str, DataFrame]:
    """Drop orphans top-down: a transaction survives only with its account."""
    kept = dict(tables)
    for name, entity in ENTITIES.items():
        kept[name] = enforce_entity(kept[name], entity, kept)
    return kept
