"""Quantiles as lazy one-row frames, and median imputation on top of them.

Nothing here runs a job while the plan is built. A quantile enters another
plan as an uncorrelated scalar subquery, which Spark evaluates once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators import sketches

_SKETCH = 10_000  # rank error of the sketches: 1/10000 of the rows
ERROR = 1 / _SKETCH
_GRID = 512  # points of the second sketch; a power of two for the search below


def quantile(df: DataFrame, column: str, p: float, exact: bool = False, error: float = ERROR) -> DataFrame:
    """One row, one column ``quantile``; NULL when there is no value.

    NULL, NaN and infinite values are ignored. The default is a mergeable sketch with rank
    error ``error``. ``exact`` gives the smallest value whose share of rows at or
    below it reaches ``p`` (SQL's ``percentile_disc``).
    """
    finite = F.abs(F.col(column).cast("double")) < F.lit(float("inf"))  # NaN is above infinity
    values = df.select(F.when(finite, F.col(column)).alias("x"))
    if exact:
        return _exact_quantile(values, p)
    # Spark's sketch may be a row further off than the error it is asked for, which is more than
    # ``error`` of a few ten thousand rows. With half of that there is room for the row, or the sketch keeps all.
    return values.agg(F.percentile_approx("x", p, 2 * round(1 / error)).alias("quantile"))


def _exact_quantile(values: DataFrame, p: float) -> DataFrame:
    """Two passes over one column, neither of which gathers the column.

    1. A sketch gives a narrow bracket around the quantile: values of 8 in 10,000 ranks. Its error
       is a quarter of the slack, so the wanted rank is on an edge of the bracket or inside.
    2. The values inside are counted, each distinct one; of the rest only how many are below, on
       each edge and above.

    What follows reads these counts, which are one shuffle that all steps share:

    3. A sketch cuts the distinct values inside at 511 of their quantiles, and the rows are summed by place:
       below, on and between these points (at most 1,029 places). The place in which the
       wanted rank falls is picked from the sums.
    4. If that place is one value, it is the answer. Else it lies between two neighbouring
       points, with at most about 3 in a million of all rows as distinct values. They are summed up.

    The places are ordered like the values, so the answer is exact. Places are told by the double of a
    value, as the sketches do: whole numbers above 2 ** 53 that share a double are in one place.
    """
    slack = 4.0 / _SKETCH
    around = f"array({max(0.0, p - slack)}D, {min(1.0, p + slack)}D)"
    values = values.withColumn("d", F.col("x").cast("double"))
    edges = values.agg(F.expr(f"percentile_approx(d, {around}, {_SKETCH})").alias("edges")).scalar()
    # Rows are set aside by a NULL, not by a filter: a filter would move below the
    # expression that reads x and evaluate it again for each mention.
    zone = "CASE WHEN d < edges[0] THEN 0 WHEN d = edges[0] THEN 1 WHEN d < edges[1] THEN 2 WHEN d = edges[1] THEN 3 ELSE 4 END"
    zoned = values.withColumn("edges", edges).selectExpr("x", f"CASE WHEN d IS NOT NULL THEN {zone} END AS zone")
    zoned = zoned.selectExpr("zone", "CASE WHEN zone IN (1, 2, 3) THEN x END AS x")
    # All columns are used in each step below, or the steps would not share this shuffle.
    cells = zoned.groupBy("zone", "x").agg(F.expr("count(zone) AS own"))

    inner = ", ".join(f"{i / _GRID}D" for i in range(1, _GRID))
    inside = cells.agg(F.expr(f"percentile_approx(CASE WHEN zone = 2 AND own > 0 THEN double(x) END, array({inner}), {10 * _GRID})").alias("points"))
    steps = ", ".join(str(_GRID >> i) for i in range(1, _GRID.bit_length()))
    below = f"aggregate(array({steps}), 0, (b, s) -> CASE WHEN get(points, b + s - 1) < double(x) THEN b + s ELSE b END)"
    gridded = cells.withColumn("points", inside.select(F.array_distinct("points")).scalar())
    gridded = gridded.selectExpr("x", "own", "zone", "points", f"CASE WHEN zone = 2 THEN {below} END AS below")
    on_point = "int(coalesce(get(points, below) = double(x), false))"
    place = f"CASE WHEN zone IS NOT NULL THEN struct(zone, coalesce(2 * below + {on_point}, 0) AS cell) END AS place"
    placed = gridded.selectExpr("x", "own", place)

    counts = placed.groupBy("place").agg(F.expr("sum(own) AS n"))
    counts = counts.selectExpr(
        "place", "n", "sum(n) OVER (ORDER BY place) AS upto", f"greatest(ceil({p}D * sum(n) OVER ()), 1) AS rank"
    )
    wanted = F.expr("min(CASE WHEN upto >= rank AND place IS NOT NULL THEN struct(place, rank - upto + n AS nth) END)")
    target = counts.agg(wanted.alias("t")).scalar()

    near = placed.withColumn("t", target).selectExpr("CASE WHEN place = t.place THEN x END AS x", "own", "t.nth")
    distinct = near.groupBy("x", "nth").agg(F.expr("sum(CASE WHEN x IS NOT NULL THEN own END) AS n"))
    distinct = distinct.selectExpr("x", "nth", "sum(n) OVER (ORDER BY x) AS upto")
    return distinct.agg(F.expr("min(CASE WHEN upto >= nth THEN x END) AS quantile"))


def median(
    df: DataFrame, column: str, type: str = "double", exact: bool = False, sketch: DataFrame | None = None
) -> Column:
    """The median as a scalar for use in another plan; 0 when there is none. A stored
    ``sketch`` saves the pass over ``df``."""
    middle = quantile(df, column, 0.5, exact).scalar() if exact or sketch is None else sketches.value(sketch, 0.5)
    return F.coalesce(middle.cast(type), F.lit(0).cast(type))


def impute_median(
    df: DataFrame,
    column: str,
    source: DataFrame | None = None,
    type: str = "double",
    exact: bool = False,
    sketch: DataFrame | None = None,
) -> DataFrame:
    """Replace NULLs of ``column`` by the median taken over ``source``.

    ``source`` defaults to the frame itself; cleaners pass the rows as loaded,
    before keyless rows and duplicates are dropped.
    """
    filled = F.coalesce(F.col(column), median(source if source is not None else df, column, type, exact, sketch))
    return df.withColumn(column, filled)
