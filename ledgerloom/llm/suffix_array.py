"""Suffix sorting by the difference cover modulo 3, as Spark jobs.

The text is a table of symbols at positions 0, 1, 2 ...; its last symbol is unlike all
others, so no suffix is a prefix of another and no padding is needed. Triples at
positions not divisible by 3 are sorted and named by their rank; if names repeat, the
string of names (those of positions 1 mod 3, then 2 mod 3) is sorted the same way. The remaining
suffixes are merged in by two sorts: with those of 1 mod 3 by (symbol, rank of the next
suffix), with those of 2 mod 3 by (symbol, symbol, rank of the next but one). How many of the
other classes come before a suffix in these orders adds up to its rank.

Who compares suffixes up to ``depth`` symbols only needs no order beyond: a name of the k-th level
stands for 3 ** k symbols, and the recursion ends where these are enough. Names count the
triples before them, so that names that repeat are ranks, too; suffixes alike that far share a range
of ranks and get numbers of their own by position. The number of levels then doesn't grow with the text.

All sorts are range partitions of distinct keys, so no frequent symbol fills a task, and
a triple is counted before it is shuffled. What a task holds whole is a block of
``BLOCK`` positions. To the driver come a few numbers for each partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import cut, new_folder, remove, stored

BLOCK = 1 << 15
#: A text of so many symbols is sorted in one task.
SMALL = 1 << 18


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sorted_parts(df: DataFrame, *keys: str, part: bool = False) -> DataFrame:
    """``df`` in range partitions, sorted and stored: its partitions and the order in
    them are fixed from here on. With ``part``, their numbers are a column."""
    ordered = df.repartitionByRange(partitions(df), *keys).sortWithinPartitions(*keys)
    return cut(ordered.withColumn("part", F.spark_partition_id()) if part else ordered)


def _before(counts: list, names: list) -> dict:
    """(partition, name) to how many rows of that name are in earlier partitions."""
    out, sums = {}, dict.fromkeys(names, 0)
    of = {(r[0], r[1]): r[2] for r in counts}
    for part in sorted({p for p, _ in of}):
        for name in names:
            out[part, name] = sums[name]
            sums[name] += of.get((part, name), 0)
    return out


def numbered(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """``df``, whose partitions are fixed, with the running number of each row, or the
    sum of the weights before it."""
    weigh = F.sum(weight) if weight else F.count("*")
    counts = df.groupBy(F.spark_partition_id()).agg(weigh).collect()
    start = _before([(p, 0, n) for p, n in counts], [0])
    schema = T.StructType([*df.schema.fields, T.StructField(column, T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = start.get((TaskContext.get().partitionId(), 0), 0)
        for batch in batches:
            size = batch.column(batch.schema.get_field_index(weight)).to_numpy() if weight else np.ones(batch.num_rows, np.int64)
            ends = at + np.cumsum(size)
            at = int(ends[-1]) if len(ends) else at
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends - size, pa.int64())], names=[*batch.schema.names, column])

    return df.mapInArrow(number, schema)


def with_halo(position: Column, halo: int, size: int = BLOCK) -> Column:
    """The blocks that need a position: its own, and the one before if it is among the
    first ``halo`` of its own."""
    own = F.floor(position / size)
    return F.explode(F.when((position % size < halo) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own)))


def _blocks(symbols: DataFrame, size: int) -> DataFrame:
    """(block, data): the symbols of a block and the two after it."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        data = rows.sort_values("pos")["sym"].to_numpy("<i8").tobytes()
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "data": [data]})

    spread = symbols.select("pos", "sym", with_halo(F.col("pos"), 2, size).alias("block"))
    return spread.groupBy("block").applyInPandas(pack, "block long, data binary")


def _symbols(data: bytes, block: int, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a block, and its symbols with two more that are 0 past the end."""
    own = min(size, n - block * size)
    held = np.zeros(own + 2, np.int64)
    found = np.frombuffer(data, "<i8")
    held[: len(found)] = found
    return block * size + np.arange(own), held


def _triples(blocks: DataFrame, n: int, size: int) -> DataFrame:
    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist(), strict=True):
                at, held = _symbols(data, block, n, size)
                own = at % 3 != 0
                columns = [at[own], *(held[i : len(at) + i][own] for i in range(3))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["pos", "a", "b", "c"])

    return blocks.mapInArrow(cover, "pos long, a long, b long, c long")


def _merge_keys(blocks: DataFrame, ranks: DataFrame, n: int, size: int) -> DataFrame:
    """Rows (other, pos, x, y, z): the keys that order the positions 0 mod 3 and those of the
    other class, 1 or 2."""
    spread = ranks.select("pos", "rank", with_halo(F.col("pos"), 2, size).alias("block"))

    def keys(text: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if text.empty:
            return pd.DataFrame({c: [] for c in ("other", "pos", "x", "y", "z")})
        block = int(text["block"].iloc[0])
        at, held = _symbols(text["data"].iloc[0], block, n, size)
        rank = np.zeros(len(held), np.int64)  # 0 past the end
        place = known["pos"].to_numpy() - block * size
        good = (place >= 0) & (place < len(rank))
        rank[place[good]] = known["rank"].to_numpy()[good] + 1
        own, cls, zero = len(at), at % 3, np.zeros(len(at), np.int64)
        parts = []
        for other, columns in ((1, (held[:own], rank[1 : own + 1], zero)), (2, (held[:own], held[1 : own + 1], rank[2:]))):
            some = (cls == 0) | (cls == other)
            x, y, z = (c[some] for c in columns)
            parts.append(pd.DataFrame({"other": other, "pos": at[some], "x": x, "y": y, "z": z}))
        return pd.concat(parts)

    return blocks.groupBy("block").cogroup(spread.groupBy("block")).applyInPandas(
        keys, "other long, pos long, x long, y long, z long"
    )


def _shares(ordered: DataFrame) -> DataFrame:
    """What the order of the classes 0 and ``other`` adds to the rank of each position: how
    many of class 0 come before; for class 0 itself, how many of the other class do,
    and in the order with class 1 those of class 0, too."""
    counts = ordered.groupBy("part", "other", F.col("pos") % 3).count().collect()
    start = _before([(part, (other, cls), n) for part, other, cls, n in counts], [(1, 0), (1, 1), (2, 0), (2, 2)])
    kind = pa.schema([("pos", pa.int64()), ("rank", pa.int64())])

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            part, places, others = batch.column("part")[0].as_py(), batch.column("pos").to_numpy(), batch.column("other").to_numpy()
            for other in (1, 2):
                pos = places[others == other]
                cls, less = pos % 3, {}
                for i in (0, other):
                    before = at.get((other, i), start.get((part, (other, i)), 0))
                    ends = before + np.cumsum(cls == i)
                    less[i] = ends - (cls == i)
                    at[other, i] = int(ends[-1]) if len(ends) else before
                rank = np.where(cls == 0, less[other] + (less[0] if other == 1 else 0), less[0])
                yield pa.RecordBatch.from_arrays([pa.array(pos), pa.array(rank, pa.int64())], schema=kind)

    return ordered.mapInArrow(share, "pos long, rank long")


def _sort_small(symbols: DataFrame) -> DataFrame:
    def ranks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("pos")
        rank, step, size = np.unique(rows["sym"].to_numpy(), return_inverse=True)[1].astype(np.int64), 1, len(rows)
        while size and rank.max() < size - 1:
            after = np.zeros(size, np.int64)
            after[: max(0, size - step)] = rank[step:] + 1
            rank = np.unique(rank * (size + 1) + after, return_inverse=True)[1].astype(np.int64)
            step *= 2
        yield pd.DataFrame({"pos": rows["pos"], "rank": rank})

    return symbols.repartition(1).mapInPandas(ranks, "pos long, rank long")


def suffix_ranks(
    symbols: DataFrame, n: int, small: int = SMALL, size: int = BLOCK, depth: int | None = None, among: DataFrame | None = None
) -> DataFrame:
    """Of rows (pos, sym), with positions 0 to n - 1 and a last symbol that occurs
    once: (pos, rank), the rank of each suffix from 0. With ``depth``, suffixes
    with so many symbols in common are in any order. With ``among``, rows (pos), only
    the suffixes of these are ranked."""
    ranks, exact = _ranks(symbols, n, small, size, depth or n)
    if among is not None:
        ranks, exact = ranks.join(among, "pos"), False
    if exact:
        return ranks
    near = sorted_parts(ranks.withColumnRenamed("rank", "near"), "near", "pos")
    return numbered(near, "rank").select("pos", "rank")


def _ranks(symbols: DataFrame, n: int, small: int, size: int, depth: int) -> tuple[DataFrame, bool]:
    """(pos, rank), and whether the ranks are exact. If not, suffixes that differ in the first ``depth``
    symbols are in order, and those that don't may have ranks of one another."""
    if n <= max(small, 3):
        return cut(_sort_small(symbols)) if n else symbols.select("pos", F.lit(0).cast("long").alias("rank")), True
    folder = new_folder(symbols.sparkSession, "suffixes")
    blocks = stored(_blocks(symbols, size), f"{folder}/blocks")
    triples = _triples(blocks, n, size)
    kinds = sorted_parts(triples.groupBy("a", "b", "c").count(), "a", "b", "c")
    distinct, sampled = kinds.count(), n - (n + 2) // 3
    named = numbered(kinds, "name", "count").drop("count")
    names = stored(triples.join(named, ["a", "b", "c"]).select("pos", "name"), f"{folder}/names")
    exact = distinct == sampled
    if exact or depth <= 3:
        ranks = names.withColumnRenamed("name", "rank")
    else:
        ones = (n + 1) // 3
        third = F.floor(F.col("pos") / 3)
        place = F.when(F.col("pos") % 3 == 1, third).otherwise(third + ones)
        inner, exact = _ranks(names.select(place.alias("pos"), F.col("name").alias("sym")), sampled, small, size, -(-depth // 3))
        back = F.when(F.col("pos") < ones, F.col("pos") * 3 + 1).otherwise((F.col("pos") - ones) * 3 + 2)
        ranks = inner.select(back.alias("pos"), "rank")
    keys = stored(_merge_keys(blocks, ranks, n, size), f"{folder}/keys")
    # Positions tell alike keys apart, so that they need not be in one task.
    ordered = sorted_parts(keys, "other", "x", "y", "z", "pos", part=True)
    found = cut(_shares(ordered).union(ranks.select("pos", "rank")).groupBy("pos").agg(F.sum("rank").alias("rank")))
    remove(folder)
    return found, exact
