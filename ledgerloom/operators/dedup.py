"""One row per key, the same one on every run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    newest: str | None = None,
    prefer: Sequence[str] = (),
    missing: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Keep one row per key: the newest, then the lowest ``prefer`` columns.

    ``missing`` says which value of a column stands for an unknown one. Known values
    come before it, as they do before NULL.

    What is still tied is decided by the remaining ``columns``, so only rows
    equal in every column compete and the result does not depend on how the
    input is split. Each task first keeps its own best row of a key (Spark's
    window group limit), so a key with many copies is never gathered whole:
    the shuffle carries at most one row per key and task.

    A column that is never NULL is NULL in place of its missing value until the row is picked:
    to order by an expression, Spark would shuffle and sort its value beside the column. The
    values in ``missing`` are text or days, so that equal ones are the same.
    """
    missing = missing or {}
    blanked = [c for c in columns if c in missing and c != key and not df.schema[c].nullable]

    def known(c: str) -> Column:
        return F.nullif(F.col(c), missing[c]) if c in missing and c not in blanked else F.col(c)

    def restored(c: str) -> Column:
        return F.coalesce(F.col(c), missing[c]).alias(c) if c in blanked else F.col(c)

    order = [known(newest).desc_nulls_last()] if newest else []
    ranked = [key, newest, *prefer]
    order += [known(c).asc_nulls_last() for c in [*prefer, *(c for c in columns if c not in ranked)]]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    rows = df.withColumns({c: F.nullif(F.col(c), missing[c]) for c in blanked}) if blanked else df
    return rows.withColumn("_place", place).filter("_place = 1").select(*map(restored, columns))
