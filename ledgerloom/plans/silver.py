"""Silver: typed, deduplicated, imputed tables from dirty raw ones.

One generic plan serves all entities: a projection reads every field, a filter
drops rows that cannot be identified, one row per key is kept, and amounts
are imputed last. The median is taken over all raw rows in a scalar subquery,
so a plan that does not use the amount never computes it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import ident, placeholders, read_fields
from ledgerloom.model import ACCOUNTS, AUDIT_COLUMN, BRANCHES, CUSTOMERS, LOANS, TRANSACTIONS, Entity
from ledgerloom.operators import sketches
from ledgerloom.operators.dedup import latest_by
from ledgerloom.operators.quantile import median


def require_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def require_fks(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        df = require_key(df, key)
    return df


def clean(
    raw: DataFrame,
    entity: Entity,
    require_fk: bool = True,
    optional_fks: Sequence[str] = (),
    exact: bool = False,
    prefer: Sequence[str] = (),
    audit: bool | Column = True,
    sketch: DataFrame | None = None,
    rows: DataFrame | None = None,
) -> DataFrame:
    """Clean a raw table that has the entity's columns as text.

    ``require_fk`` drops rows without foreign keys, apart from ``optional_fks``
    (columns the source does not have). ``prefer`` names extra raw columns, such
    as a load order, of which the lowest wins among duplicates. ``exact`` uses
    the exact median instead of a sketch, ``sketch`` the stored ones of :func:`amount_sketches`.
    ``audit`` adds the time of loading, or the time given. ``rows`` are the rows of ``raw`` to
    clean where not all are wanted (:func:`of_keys`); the medians stay those of ``raw``.
    """
    typed = read_fields(raw, entity.fields, prefer)
    rows = require_key(typed if rows is None else read_fields(rows, entity.fields, prefer), entity.key)
    if require_fk:
        rows = require_fks(rows, [k for k in entity.foreign_keys if k not in optional_fks])
    rows = latest_by(rows, entity.key, entity.columns, entity.latest, prefer, placeholders(entity.fields))
    for f in entity.amounts:
        own = sketch.where(F.col("amount") == f.name) if sketch is not None else None
        rows = rows.withColumn(f.name, F.coalesce(F.col(f.name), median(typed, f.name, f.type, exact, own)))
    if audit is False:
        return rows
    return rows.withColumn(AUDIT_COLUMN, F.current_timestamp() if audit is True else audit)


def amount_sketches(raw: DataFrame, entity: Entity) -> DataFrame:
    """Sketches of the amounts of a raw table, over all rows that can be read, as its
    medians ask for. To be stored, and merged with those of other loads."""
    typed = read_fields(raw, entity.amounts)
    return reduce(DataFrame.unionByName, (sketches.sketch(typed, f.name, F.lit(f.name).alias("amount")) for f in entity.amounts))


def idents(raw: DataFrame, column: str) -> DataFrame:
    """The normalised identifiers in a raw column, one per raw row."""
    return require_key(raw.select(ident(column).alias(column)), column)


def known_keys(raw: DataFrame, entity: Entity) -> DataFrame:
    """Keys the cleaned table will have, without cleaning it.

    Only for entities without foreign keys. A key may repeat, which a semi or
    anti join does not mind.
    """
    if entity.foreign_keys:
        raise ValueError(f"{entity.name} loses rows to its foreign keys")
    return idents(raw, entity.key)


def keys_with(raw: DataFrame, entity: Entity, wanted: DataFrame) -> DataFrame:
    """The keys of an entity that have a raw row, be it one that a cleaner drops as a copy, whose foreign key
    is in ``wanted``, a frame of that one column."""
    (fk,) = wanted.columns
    pairs = raw.select(ident(entity.key).alias(entity.key), ident(fk).alias(fk))
    return require_key(pairs.join(wanted, fk, "left_semi").select(entity.key), entity.key).distinct()


def of_keys(raw: DataFrame, entity: Entity, keys: DataFrame) -> DataFrame:
    """All raw rows of the keys given, as they are."""
    named = raw.withColumn("_key", ident(entity.key))
    return named.join(keys.select(F.col(entity.key).alias("_key")), "_key", "left_semi").select(raw.columns)


def clean_customers(raw: DataFrame, **options) -> DataFrame:
    return clean(raw, CUSTOMERS, **options)


def clean_branches(raw: DataFrame, **options) -> DataFrame:
    return clean(raw, BRANCHES, **options)


def clean_accounts(raw: DataFrame, **options) -> DataFrame:
    return clean(raw, ACCOUNTS, **options)


def clean_loans(raw: DataFrame, **options) -> DataFrame:
    return clean(raw, LOANS, **options)


def clean_transactions(raw: DataFrame, **options) -> DataFrame:
    return clean(raw, TRANSACTIONS, **options)
