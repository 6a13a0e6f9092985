"""Mixing sources to target weights by Pfair scheduling.

The rows of a source are dealt into blocks. In a schedule of one block a slot, block j
(from 1) of a source with weight w is released at slot floor((j - 1) / w) and due by
slot ceil(j / w). Taking the released block with the earliest deadline meets all
deadlines, so after every slot each source is less than one block away from its
weight times the slots so far.

Weights are taken exactly, as fractions, and never rounded: the schedule is worked out on
the driver slot by slot, with the state of each source and nothing else in memory, and
goes to a table in the shared folder, a row for each slot. Weights whose whole-numbered
form adds up to less than the schedule's length repeat after so many slots, and only
these are worked out. The driver's time grows with the number of blocks. Within its
source, the order of the rows is a hash of their ids: a shuffle that every run repeats.

No row is dropped. The schedule goes on until every block has had its slot; sources that
are used up before start again, so a small source with a large weight comes in
several epochs.

Defined results: rows with a null source are a source of their own; repeated rows stay,
and equal ones are interchangeable; a weight of 0 or less, or none among given
weights, is an error (a source that shall not come in is to be filtered out); an
empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyarrow import parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerloom.llm.common import cut, free_name, new_folder, opened, remove

BLOCK_ROWS = 16
FLATTEN = 0.7
BUCKET_ROWS = 2000
FLUSH = 1 << 20


def whole_weights(weights: dict, period: int) -> dict:
    """Weights as whole numbers of at least 1 that add up to the period, by largest
    remainders. The period is no shorter than ten slots a source."""
    if not weights or any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be over 0")
    period, total = max(period, 10 * len(weights)), sum(weights.values())
    exact = {k: period * w / total for k, w in weights.items()}
    out = {k: max(1, int(x)) for k, x in exact.items()}
    name = lambda k: (k is not None, str(k))
    for k in sorted(out, key=lambda k: (out[k] - exact[k], name(k)))[: max(0, period - sum(out.values()))]:
        out[k] += 1
    # Weights that were lifted to 1 are taken from the largest.
    largest = [(-n, name(k), k) for k, n in out.items()]
    heapq.heapify(largest)
    for _ in range(sum(out.values()) - period):
        n, order, k = largest[0]
        out[k] -= 1
        heapq.heapreplace(largest, (n + 1, order, k))
    return out


def exact_weights(weights: dict) -> dict:
    """Weights as the smallest whole numbers that are exactly in their proportions."""
    if not weights or any(not 0 < w < math.inf for w in weights.values()):
        raise ValueError("weights must be over 0")
    exact = {k: Fraction(w) for k, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    out = {k: int(x * scale) for k, x in exact.items()}
    shared = math.gcd(*out.values())
    return {k: n // shared for k, n in out.items()}


def turns(weights: list[int]) -> Iterator[tuple[int, int]]:
    """(place of the source, its block) of one slot after the other, without an end."""
    total, slot = sum(weights), 0
    # Heaps of (time, place of the source): blocks to be released, blocks to be chosen.
    later = [(0, at) for at in range(len(weights))]
    ready: list[tuple[int, int]] = []
    done = [0] * len(weights)
    while True:
        while later and later[0][0] <= slot:
            _, at = heapq.heappop(later)
            heapq.heappush(ready, (-(-(done[at] + 1) * total // weights[at]), at))
        _, at = heapq.heappop(ready)
        yield at, done[at]
        done[at] += 1
        heapq.heappush(later, (done[at] * total // weights[at], at))
        slot += 1


def one_period(counts: dict) -> list[tuple[object, int, int]]:
    """(source, its block, slot) of a period, blocks and slots from 0."""
    names = sorted(counts, key=lambda k: (k is not None, str(k)))
    found = islice(turns([counts[k] for k in names]), sum(counts.values()))
    return [(names[at], block, slot) for slot, (at, block) in enumerate(found)]


def _stored_turns(folder: str, weights: list[int], blocks: list[int]) -> tuple[int, bool]:
    """Write the slots (src, turn, slot) up to the last first showing of a block, or of one
    whole period if that is shorter. Returns the length of the schedule, and whether it
    was a period."""
    kind = pa.schema([("src", pa.int32()), ("turn", pa.int64()), ("slot", pa.int64())])
    total, left, slot = sum(weights), len(blocks), 0
    # In a period: the slot of the block that stands for the source's last one.
    last = [0] * len(blocks)
    store, path = opened(folder)
    store.create_dir(path)
    with pq.ParquetWriter(f"{path}/turns.parquet", kind, filesystem=store) as file:
        held = array("i"), array("q"), array("q")

        def flush() -> None:
            file.write_table(pa.table([pa.array(memoryview(c), f.type) for c, f in zip(held, kind, strict=True)], schema=kind))
            for column in held:
                del column[:]

        for at, block in turns(weights):
            for column, value in zip(held, (at, block, slot), strict=True):
                column.append(value)
            if len(held[0]) >= FLUSH:
                flush()
            left -= block == blocks[at] - 1
            if block == (blocks[at] - 1) % weights[at]:
                last[at] = slot
            slot += 1
            if not left or slot == total:
                break
        flush()
    if not left:
        return slot, False
    return max((n - 1) // w * total + s + 1 for n, w, s in zip(blocks, weights, last, strict=True)), True


def _named(source: Column) -> Column:
    """A source as a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def mix(
    docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", source_col: str = "source",
    text_col: str = "text", block_rows: int = BLOCK_ROWS, period: int | None = None, out: tuple[str, str, str] = ("slot", "place", "epoch"),
) -> DataFrame:
    """``docs`` with three columns, which must be free: the slot of the block, the place in
    the block and the epoch of the source. Without ``weights``, sources weigh in with
    their number of blocks to the power 0.7, so that small ones count for more. With a
    ``period``, weights are first rounded to whole blocks out of so many slots."""
    spark = docs.sparkSession
    names = {k: free_name(docs, k) for k in ("source", "bucket", "before", "place", "first", "slots", "block")}
    supply = docs.groupBy(_named(F.col(source_col)).alias("source")).agg(F.count("*").alias("n")).collect()
    blocks = {r.source: -(-r.n // block_rows) for r in sorted(supply, key=lambda r: r.source)}
    if weights is not None:
        weights = {"" if k is None else f"={k}": w for k, w in weights.items()}
        if lacking := sorted(k.removeprefix("=") for k in blocks if k not in weights):
            raise ValueError(f"no weight for {lacking[:5]}")
    if not blocks:
        return docs.select("*", *(F.lit(0).cast("long").alias(c) for c in out))
    chosen = {k: weights[k] if weights else n**FLATTEN for k, n in blocks.items()}
    whole = whole_weights(chosen, period) if period else exact_weights(chosen)

    # Rows are ranked inside buckets of the hash, and buckets by their counts.
    src, bucket, place, before = (names[k] for k in ("source", "bucket", "place", "before"))
    key, buckets = [src, bucket], max(1, -(-sum(r.n for r in supply) // BUCKET_ROWS))
    row_id = F.col(id_col).cast("long")
    draw = F.xxhash64(row_id, F.lit(11))
    rows = docs.withColumn(src, _named(F.col(source_col))).withColumn(bucket, F.pmod(draw, F.lit(buckets)))
    inside = W.partitionBy(*key).orderBy(draw, row_id, F.xxhash64(F.col(text_col).cast("string")))
    ranked = rows.withColumn(place, F.row_number().over(inside) - 1)
    counts = rows.groupBy(*key).agg(F.count("*").alias("n"))
    rows = ranked.join(_bucket_slots(spark, counts, names, blocks, whole, block_rows), key)

    # Place of the row in its source, from 0, and its block; a slot for each epoch.
    nth = F.col(place) + F.col(before)
    own = F.element_at(F.col(names["slots"]), (F.floor(nth / block_rows) - F.col(names["first"]) + 1).cast("int"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = rows.select(*columns, (nth % block_rows).alias(place), F.posexplode(own["slots"]).alias(src, names["block"]))
    return rows.select(*columns, F.col(names["block"]).alias(out[0]), F.col(place).alias(out[1]), F.col(src).cast("long").alias(out[2]))


def _bucket_slots(
    spark: SparkSession, counts: DataFrame, names: dict[str, str], blocks: dict, whole: dict, block_rows: int
) -> DataFrame:
    """For each source and bucket: the rows of the source before it, its first block, and
    of each of its blocks the slots, by epoch."""
    src, bucket, before, first, slots, block = (names[k] for k in ("source", "bucket", "before", "first", "slots", "block"))
    key, total = [src, bucket], sum(whole.values())
    folder = new_folder(spark, "turns")
    length, repeats = _stored_turns(folder, [whole[k] for k in blocks], list(blocks.values()))
    table = spark.read.schema("src int, turn long, slot long").parquet(folder)
    # At most so many blocks of a source have their slot before the end.
    shape = [(k, at, n, whole[k] if repeats else length + 1, -(-length * whole[k] // total)) for at, (k, n) in enumerate(blocks.items())]
    # Bounded by the sources, which the driver has anyway.
    shape = F.broadcast(spark.createDataFrame(shape, f"{src} string, src int, stock long, share long, most long"))
    up_to = W.partitionBy(src).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    spans = counts.select(*key, "n", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias(before))
    spans = spans.withColumn(first, F.floor(F.col(before) / block_rows))
    showings = (
        spans.withColumn(block, F.explode(F.sequence(first, F.floor((F.col(before) + F.col("n") - 1) / block_rows))))
        .join(shape, src)
        .withColumn("nth", F.explode(F.sequence(F.col(block), F.col("most") - 1, F.col("stock"))))
        .withColumn("turn", F.col("nth") % F.col("share"))
        .join(table, ["src", "turn"])
        .withColumn("slot", F.floor(F.col("nth") / F.col("share")) * F.lit(total if repeats else 0) + F.col("slot"))
        .where(F.col("slot") < length)
    )
    by_block = showings.groupBy(*key, before, first, block).agg(F.sort_array(F.collect_list("slot")).alias("slots"))
    out = cut(by_block.groupBy(*key, before, first).agg(F.sort_array(F.collect_list(F.struct(block, "slots"))).alias(slots)))
    remove(folder)
    return out
