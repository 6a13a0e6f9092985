"""Joins on a key that may hold a large part of the rows.

A shuffle join sends all rows of a key to one task. Spark's adaptive skew
handling splits such a task when it sees it. Where the heavy keys can be known
before the join, the plan here is even from the start: the rows of a heavy key
are dealt onto slices, and only the parent rows of heavy keys are repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 1e-4


def hot_keys(df: DataFrame, key: str, share: float = SHARE, probe: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """Keys holding at least ``share`` of the rows, with a number of slices.

    At most ``1/share`` keys can qualify, so the result is always small. Counts
    are combined before the shuffle. With ``probe`` one row in so many is counted,
    chosen by the hash of the columns ``by`` that identify it: whenever the keys are
    worked out, they come out the same.
    """
    counted = df.filter(F.col(key).isNotNull())
    if probe > 1:
        counted = counted.filter(F.pmod(F.xxhash64(*by), F.lit(probe)) == 0)
    counted = counted.select(key)
    counts = counted.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    # Two rows at least, so that no key of a tiny table counts as heavy.
    bar = F.greatest(counted.agg(F.count(F.lit(1))).scalar() * F.lit(share), F.lit(2.0))
    return counts.filter(F.col("n") >= bar).select(key, F.ceil(F.col("n") / bar).cast("int").alias("slices"))


def sliced_join(
    child: DataFrame, parent: DataFrame, key: str, how: str, hot: DataFrame, spread: Sequence[str]
) -> DataFrame:
    """``child.join(parent, key, how)`` with the rows of hot keys dealt out.

    ``hot`` deals both sides, so it must give the same rows twice: a stored table, or
    :func:`hot_keys` of one. ``parent`` must be unique in ``key``. ``how`` is inner, left, left_semi or
    left_anti. ``spread`` names child columns that differ between rows of a
    key (its identifier); their hash picks the slice.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"slicing repeats parent rows, which {how!r} would show")
    heavy = F.broadcast(hot.select(key, "slices"))  # at most 1/share rows
    hashed = F.xxhash64(*spread)
    # A NULL key matches nothing, so its rows may go anywhere.
    dealt = (
        F.when(F.col(key).isNull(), hashed)
        .when(F.col("slices").isNotNull(), F.pmod(hashed, F.col("slices").cast("long")))
        .otherwise(F.lit(0))
    )
    child = child.join(heavy, key, "left").withColumn("_slice", dealt.cast("long")).drop("slices")
    repeated = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("slices") - 1, F.lit(0)).cast("long"))
    parent = parent.join(heavy, key, "left").withColumn("_slice", F.explode(repeated)).drop("slices")
    return child.join(parent, [key, "_slice"], how).drop("_slice")


def parent_join(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    how: str,
    hot: DataFrame | None = None,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Join to a parent unique in ``key``: plain, or sliced if ``hot`` is given.

    Semi and anti joins return the child's columns in the child's order.
    """
    joined = child.join(parent, key, how) if hot is None else sliced_join(child, parent, key, how, hot, spread)
    return joined.select(child.columns) if how in ("left_semi", "left_anti") else joined


def outer_join_many(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """``parent.join(child, key, "left")`` where a parent may have very many rows.

    An outer join cannot split the side it does not preserve, so a parent
    with a third of the child rows would be one task. Matched rows therefore
    come from an inner join, which adaptive execution splits on either side,
    and parents without a child are added from an anti join on distinct keys.
    """
    matched = child.join(parent, key, "inner")
    lone = parent.join(child.select(key).distinct(), key, "left_anti")
    return matched.unionByName(lone, allowMissingColumns=True)
