"""Sums of doubles that do not depend on the order of addition.

A double is a whole number times a power of two. Amounts are put into bins by their
exponent, ``BIN`` powers of two to a bin; counted in the unit of its bin every amount is a whole
number, and whole numbers add exactly in any order. A group has a row for each bin that its
amounts fall into, mostly one or two. Its sum is put together from them at the end, from the
smallest bin up and with the rounding errors carried along, and is rounded to a double once.

So the same rows give the same sum on any partitioning, and rows of such partial sums may be
joined and added up again. Infinite amounts and NaN are kept apart and follow the rules of
doubles: a group with one has no finite sum.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import measures as m

BIN = 32
#: What a column of :func:`grouped` is; ``known(c)`` counts the rows that have a value of ``c``.
TOTAL, MEAN, ROWS = "total", "mean", "rows"

# A unit is under 2 ** 88; it is summed in a high and a low part of 44 bits each.
_PART, _HALF = 1 << 44, 1 << 50
_SUMS = ("_high", "_low", "_special", "_known")


def known(column: str) -> tuple[str, str]:
    return "known", column


def grouped(
    df: DataFrame, keys: Sequence[str | Column], amount: str, columns: Mapping[str, str | tuple], scale: int | None = None
) -> DataFrame:
    """``df`` by ``keys``, with the named ``columns``. ``scale`` sums decimals, see
    :mod:`ledgerloom.functions.measures`; without it doubles are summed as told above."""
    if scale is not None:
        return df.groupBy(*keys).agg(*(_decimal(kind, amount, name, scale) for name, kind in columns.items()))
    return finished(units(df, keys, amount, columns), _names(df, keys), columns, summed=True)


def _names(df: DataFrame, keys: Sequence[str | Column]) -> list[str]:
    return df.select(*keys).columns


def _decimal(kind: str | tuple, amount: str, name: str, scale: int) -> Column:
    match kind:
        case "total":
            return m.total(amount, name, scale)
        case "mean":
            return m.mean(amount, name, scale)
        case "rows":
            return m.rows(name)
    return m.known(kind[1], name)


def units(df: DataFrame, keys: Sequence[str | Column], amount: str, columns: Mapping[str, str | tuple]) -> DataFrame:
    """Exact partial sums: a row for each group and bin."""
    x = f"CAST(`{amount}` AS DOUBLE)"
    # Three bits more than the mantissa needs: the logarithm may be off by one near a power of two.
    place = f"CASE WHEN abs(_x) < double('Infinity') AND _x <> 0 THEN CAST(floor((floor(log2(abs(_x))) - 54) / {BIN}) AS INT) END"
    counted = {c for kind in columns.values() if isinstance(kind, tuple) for c in kind[1:]}
    rows = df.select(*keys, F.expr(f"{x} AS _x"), *(F.col(c).isNotNull().alias(f"_has_{c}") for c in counted))
    rows = rows.withColumn("_bin", F.expr(place))
    # In two steps, as the power itself may be no double.
    rows = rows.withColumn("_units", F.expr(f"_x * pow(2D, -{BIN // 2} * _bin) * pow(2D, -{BIN // 2} * _bin)"))
    high = f"floor(_units / {_PART}D)"
    whole = "CAST(CAST({} AS BIGINT) AS DECIMAL(18,0))"
    return rows.groupBy(*_names(df, keys), "_bin").agg(
        F.expr(f"sum({whole.format(high)}) AS _high"),
        F.expr(f"sum({whole.format(f'_units - CAST({high} AS DOUBLE) * {_PART}D')}) AS _low"),
        F.expr("sum(CASE WHEN NOT abs(_x) < double('Infinity') THEN _x END) AS _special"),
        F.expr("count(_x) AS _known"),
        F.expr("count(1) AS _rows"),
        *(F.count_if(f"_has_{c}").alias(f"_has_{c}") for c in counted),
    )


def finished(partial: DataFrame, keys: Sequence[str], columns: Mapping[str, str | tuple], summed: bool = False) -> DataFrame:
    """The sums of :func:`units`, rounded once. ``summed`` says that there is one row for each group and bin."""
    counts = [c for c in partial.columns if c == "_rows" or c.startswith("_has_")]
    if not summed:
        partial = partial.groupBy(*keys, "_bin").agg(*(F.sum(c).alias(c) for c in (*_SUMS, *counts)))
    # A double has less than 70 bins.
    bins = "sort_array(collect_list(CASE WHEN _bin IS NOT NULL THEN struct(_bin, _high, _low) END)) AS _bins"
    whole = partial.groupBy(*keys).agg(F.expr(bins), F.sum("_special").alias("_special"), *(
        F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("_known", *counts)
    ))
    unit = f"pow(2D, {BIN // 2} * b._bin)"
    # Four whole numbers that are doubles, from the smallest up.
    four = ", ".join(
        f"CAST({number} AS DOUBLE) * {power}D * {unit} * {unit}"
        for number, power in (
            (f"b._low % {_HALF}", 1), (f"b._low div {_HALF}", _HALF), (f"b._high % {_HALF}", _PART), (f"b._high div {_HALF}", _PART * _HALF)
        )
    )
    # Of every addition the error is exact: (a - (s - (s - a))) + (x - (s - a)).
    step = "struct(a.s + x AS s, a.e + (a.s - ((a.s + x) - ((a.s + x) - a.s))) + (x - ((a.s + x) - a.s)) AS e)"
    terms = f"flatten(transform(_bins, b -> array({four})))"
    total = (
        f"CASE WHEN _known = 0 THEN NULL WHEN _special IS NOT NULL THEN _special ELSE aggregate({terms}, struct(0D AS s, 0D AS e), "
        f"(a, x) -> {step}, a -> CASE WHEN abs(a.s) < double('Infinity') THEN a.s + a.e ELSE a.s END) END"
    )
    whole = whole.withColumn("_total", F.expr(total))
    made = {TOTAL: F.col("_total"), MEAN: m.ratio(F.col("_total"), F.col("_known")), ROWS: F.col("_rows")}
    return whole.select(*keys, *((F.col(f"_has_{kind[1]}") if isinstance(kind, tuple) else made[kind]).alias(name) for name, kind in columns.items()))
