"""Stored sketches of a column, and quantiles with proven ranks from them.

A sketch counts values by their leading digits: a cell holds the values with one sign,
one power of two and the same ``DIGITS`` binary digits after it, and keeps their number, the
smallest and the largest of them. Nothing depends on the order or the partitioning of the
rows, so sketches of files, days or runs can be stored and merged later, by adding the
counts of equal cells. A sketch has at most ``2 ** DIGITS`` rows for each power of two that occurs.

A quantile is the largest value of the cell in which its rank falls. The ranks of that cell are
known exactly, and they come with the answer: ``rank_high`` rows are at or below the value,
and all values of the cell have a rank of ``rank_low`` at least. Where a cell holds one
value, or as many rows as the caller can bear with, the answer needs no second look at the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 12
#: Rows of a sketch, in the order of their values.
CELL = ["power", "digits"]


def sketch(df: DataFrame, column: str, *runs: str | Column) -> DataFrame:
    """(runs..., power, digits, n, least, most) of the values that are finite: one pass, partial
    counts before the shuffle. ``runs`` are columns that name a file, day or batch."""
    finite = f"abs(CAST(`{column}` AS DOUBLE)) < double('Infinity')"
    rows = df.where(finite).select(*runs, F.col(column).alias("v"), F.expr(f"CAST(`{column}` AS DOUBLE) AS x"))
    names = rows.columns[:-2]
    kept = [*names, "v", "x"]
    # The logarithm may be off by one near a power of two: a comparison tells.
    rows = rows.selectExpr(*kept, "CAST(floor(log2(abs(x))) AS INT) AS near")
    nearer = "CASE WHEN abs(x) >= pow(2D, near + 1) THEN 1 WHEN abs(x) < pow(2D, near) THEN -1 ELSE 0 END"
    rows = rows.selectExpr(*kept, f"CASE WHEN x <> 0 THEN near + {nearer} END AS e")
    # In two steps, as the power itself may be no double.
    half = f"CAST(({DIGITS} - e) / 2 AS INT)"
    rows = rows.selectExpr(*kept, "e", f"CAST(floor(abs(x) * pow(2D, {half}) * pow(2D, {DIGITS} - e - {half})) AS INT) AS d")
    # Signed, so that the order of cells is that of values; zero is a cell of its own.
    sign = "CASE WHEN x > 0 THEN {} WHEN x < 0 THEN -{} ELSE 0 END AS {}"
    rows = rows.selectExpr(*names, "v", sign.format("(e + 2000)", "(e + 2000)", "power"), sign.format("d", "d", "digits"))
    return rows.groupBy(*names, *CELL).agg(F.count("v").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))


def merged(sketches: DataFrame, *runs: str) -> DataFrame:
    """Sketches put together, all of them or by ``runs``."""
    return sketches.groupBy(*runs, *CELL).agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))


def certified(sketches: DataFrame, p: float) -> DataFrame:
    """One row: quantile, rank_low, rank_high, n. The window is over powers of two, of which there
    are 4,097 at most, and then over the cells of one."""
    cells = merged(sketches)
    powers = cells.groupBy("power").agg(F.sum("n").alias("n"))
    order = Window.orderBy("power")
    powers = powers.select("power", (F.sum("n").over(order) - F.col("n")).alias("before"), F.sum("n").over(order).alias("upto"))
    all_rows = powers.agg(F.max("upto").alias("n"))
    rank = F.greatest(F.ceil(F.lit(p) * F.col("n")), F.lit(1)).alias("rank")
    asked = powers.join(F.broadcast(all_rows.select("n", rank)), F.expr("before < rank AND rank <= upto"))  # one row
    near = cells.withColumnRenamed("n", "own").join(F.broadcast(asked), "power")
    upto = F.col("before") + F.sum("own").over(Window.partitionBy("power").orderBy("digits"))
    near = near.withColumn("rank_high", upto).withColumn("rank_low", F.col("rank_high") - F.col("own") + 1)
    found = near.where("rank_low <= rank AND rank <= rank_high")
    # No row without values: the aggregate makes one of NULLs.
    return found.agg(
        F.max("most").alias("quantile"), F.max("rank_low").alias("rank_low"), F.max("rank_high").alias("rank_high"),
        F.coalesce(F.max("n"), F.lit(0)).alias("n"),
    )


def value(sketches: DataFrame, p: float) -> Column:
    """The quantile as a scalar for use in another plan; NULL when there is none."""
    return certified(sketches, p).select("quantile").scalar()
