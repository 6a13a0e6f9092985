"""Bronze: repeatable dirt for clean tables.

Nulls, then copies, then blanks on every table, and case noise on accounts and
customers. A row is named by ``row_id``, an expression over its clean columns
that is taken before any value is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.draws import hit
from ledgerloom.model import Entity

# How often each defect occurs, and where case noise applies.
NULL_SHARE = 0.10
COPY_SHARE = 0.05
UPPER_SHARE = 0.30
LOWER_SHARE = 0.50  # of what is not upper-cased
NOISY_CASE = ("accounts", "customers")


def map_columns(df: DataFrame, columns: list[str], fn) -> DataFrame:
    """Replace each named column by ``fn(name, position)`` in one projection."""
    return df.withColumns({c: fn(c, i) for i, c in enumerate(columns)})


def inject_nulls(df: DataFrame, columns: list[str], row_id: Column, p: float = NULL_SHARE, seed: int = 0) -> DataFrame:
    return map_columns(df, columns, lambda c, i: F.when(~hit(row_id, "null", seed, p, i), F.col(c)))


def inject_duplicates(
    df: DataFrame, row_id: Column, frac: float = COPY_SHARE, seed: int = 0, mark: str | None = None
) -> DataFrame:
    """Append a copy of a share of the rows, as they are.

    A row that is drawn turns into two in place; the table is read once.
    ``mark`` names a column to tell the copy (1) from its original (0).
    """
    once = F.array(F.lit(0))
    times = F.when(hit(row_id, "copy", seed, frac), F.array(F.lit(0), F.lit(1))).otherwise(once)
    copied = df.withColumn(mark or "_copy", F.explode(times))
    return copied if mark else copied.drop("_copy")


def nulls_to_blank(df: DataFrame, columns: list[str]) -> DataFrame:
    return map_columns(df, columns, lambda c, _: F.coalesce(F.col(c), F.lit("")))


def inject_case_noise(df: DataFrame, columns: list[str], row_id: Column, seed: int = 0) -> DataFrame:
    def noisy(c: str, i: int) -> Column:
        return (
            F.when(hit(row_id, "upper", seed, UPPER_SHARE, i), F.upper(c))
            .when(hit(row_id, "lower", seed, LOWER_SHARE, i), F.lower(c))
            .otherwise(F.col(c))
        )

    return map_columns(df, columns, noisy)


def bronze(df: DataFrame, entity: Entity, row_id: Column, seed: int = 0, numeric: tuple[str, ...] = ()) -> DataFrame:
    """All defects of one table. Columns in ``numeric`` hold no text: they get
    nulls, but neither blanks nor case noise."""
    columns = entity.columns
    text = [c for c in columns if c not in numeric]
    row = F.col("_row")
    dirty = df.select(row_id.cast("string").alias("_row"), *columns)
    dirty = inject_nulls(dirty, columns, row, seed=seed)
    dirty = inject_duplicates(dirty, row, seed=seed, mark="_copy")
    dirty = nulls_to_blank(dirty, text)
    if entity.name in NOISY_CASE:
        # A copy takes its own draws here, so it may differ from its original.
        dirty = inject_case_noise(dirty, text, F.concat_ws("#", row, F.col("_copy")), seed)
    return dirty.select(*columns)
