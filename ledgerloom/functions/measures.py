"""Aggregate expressions shared by the KPI plans.

``scale`` selects the arithmetic of money. ``None`` adds doubles, as the raw
type suggests; the last digits then depend on the order of addition. A number
of decimals adds exactly, in 38 digits, and gives the same result on any
partitioning. Nothing is rounded or left out: an amount with more decimals than that,
one that is no finite number, and a sum that does not fit fail the job with an error
that says so, whether or not ANSI mode is on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sure(value: Column, given: Column, told: str) -> Column:
    """``value``, which may be NULL only where ``given`` does not hold."""
    return F.when(given, F.coalesce(value, F.raise_error(F.lit(told))))


def _exact(value: Column, scale: int | None) -> Column:
    if scale is None:
        return value
    fits = value.try_cast(f"decimal(38,{scale})")
    same = F.when(fits.cast("double") == value.cast("double"), fits)
    return _sure(same, value.isNotNull(), f"an amount is not a number of at most {scale} decimals")


def _sum(value: Column, scale: int | None) -> Column:
    if scale is None:
        return F.sum(value)
    return _sure(F.try_sum(value), F.count(value) > 0, "a sum of amounts has more than 38 digits")


def total(column: str, name: str, scale: int | None = None) -> Column:
    return _sum(_exact(F.col(column), scale), scale).cast("double").alias(name)


def mean(column: str, name: str, scale: int | None = None) -> Column:
    if scale is None:
        return F.avg(column).alias(name)
    amount = _exact(F.col(column), scale)
    return ratio(_sum(amount, scale), F.count(amount)).alias(name)


def partial(column: str, name: str, scale: int | None = None) -> Column:
    """A sum that will be added up or weighted again; exact if asked."""
    return _sum(_exact(F.col(column), scale), scale).alias(name)


def again(column: str, scale: int | None = None) -> Column:
    """The sum of partial sums."""
    return _sum(F.col(column), scale)


def times(column: str, weight: Column, scale: int | None = None) -> Column:
    """An amount, or a sum of amounts, ``weight`` times."""
    if scale is None:
        return F.col(column) * weight
    amount = _exact(F.col(column), scale)
    product = F.try_multiply(amount, weight.cast("decimal(18,0)")).cast(f"decimal(38,{scale})")
    return _sure(product, amount.isNotNull() & weight.isNotNull(), "a weighted amount has more than 38 digits")


def weighted(column: str, weight: Column, scale: int | None = None) -> Column:
    """Sum of ``column`` with each row counted ``weight`` times."""
    return _sum(times(column, weight, scale), scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; NULL instead of a division by zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def known(column: str, name: str) -> Column:
    """Number of rows in which the column is not NULL."""
    return F.count(column).alias(name)
