"""Exact duplicates by sorting contents.

Texts are normalised (white space to one space) and the rows are dealt by sampled splitters
into ranges, sorted within each, so that equal texts come to lie next to each other; then
each row is compared in full with the one before it. The order is that of the first
``HEAD`` bytes, then of the SHA-256 of the whole text, then of the id: splitters stay small
however long the texts are, texts that share their beginning are still dealt out, and a
text of very many copies is cut between two ids, over as many tasks as it fills. Where a
range ends within equal texts, the last text of one range and the first of the next are
compared in full as well, and the runs are joined.

A task holds a batch of rows and one text more. The driver gets two numbers for each range.

Defined results: a null text is an empty one; texts without other characters are equal
to those of one space, not to empty ones. Of equal texts the row with the smallest id stays,
null ids last; of rows equal in text and id one stays. Rows equal in both can't be cut into
ranges, they are passed through one task row by row. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import free_name, new_folder, stored

HEAD = 64
_FIRST, _LAST = 1, 2  # a row at an end of its range


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Numbers the runs of equal texts (the last column) of a sorted range.

    The text gives way to: range, run, whether the row is the first of its run, whether it is
    known to be alone, at which end of the range it is, and its text if it is at one."""
    part = TaskContext.get().partitionId()
    before, run, waiting = None, -1, None

    def told(rows: pa.Table, same: np.ndarray, end: bool) -> pa.RecordBatch:
        """All rows but the last of ``same``, which tells of the row after them."""
        nonlocal run
        runs = run + np.cumsum(~same[:-1])
        edge = np.zeros(rows.num_rows, np.int8)
        edge[0] += _FIRST * (run < 0)
        edge[-1] += _LAST * end
        alone = ~same[:-1] & ~same[1:] & (runs > 0) & (edge & _LAST == 0)
        run = int(runs[-1])
        text = rows.column(-1).combine_chunks()
        text = pc.if_else(pa.array(edge > 0), text, pa.scalar(None, text.type))
        parts = pa.array(np.full(rows.num_rows, part, np.int32))
        columns = [*rows.columns[:-1], parts, pa.array(runs), pa.array(~same[:-1]), pa.array(alone), pa.array(edge), text]
        return pa.table(columns, names=names).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.num_columns - 1)
        same = np.zeros(batch.num_rows, bool)
        same[0] = before is not None and text[0].as_py() == before
        same[1:] = pc.equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)
        before = text[-1].as_py()
        # The last row waits for the one after it.
        rows = pa.Table.from_batches([batch])
        if waiting is not None:
            held, flag = waiting
            rows, same = pa.concat_tables([held, rows]), np.concatenate(([flag], same))
        waiting = rows.slice(rows.num_rows - 1), bool(same[-1])
        if rows.num_rows > 1:
            yield told(rows.slice(0, rows.num_rows - 1), same, False)
    if waiting is not None:
        yield told(waiting[0], np.array([waiting[1], False]), True)


class Sorted:
    """Rows in order of content, stored, with the runs of equal texts."""

    def __init__(self, docs: DataFrame, carried: DataFrame, id_col: str, text_col: str):
        """``carried`` is ``docs`` with the columns to keep and those named here."""
        self.columns = carried.columns
        norm = normalised(F.col(text_col))
        head, digest = free_name(carried, "head"), free_name(carried, "digest")
        self.digest = digest
        rows = carried.withColumn(head, F.substring(norm.cast("binary"), 1, HEAD)).withColumn(digest, F.unhex(F.sha2(norm, 256)))
        order = [F.col(head), F.col(digest), F.col(id_col).asc_nulls_last()]
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        kept = [*self.columns, digest]
        # The normalised text is made again here, instead of being shuffled beside the plain one.
        text = free_name(carried, "text")
        dealt = dealt.select(*kept, norm.alias(text))
        self.part, self.run, self.first, self.alone, self.edge = (free_name(carried, c) for c in ("part", "run", "first", "alone", "edge"))
        self.text = text
        kinds = T.IntegerType(), T.LongType(), T.BooleanType(), T.BooleanType(), T.ByteType(), T.StringType()
        extra = zip((self.part, self.run, self.first, self.alone, self.edge, text), kinds, strict=True)
        schema = T.StructType([f for f in dealt.schema.fields if f.name != text] + [T.StructField(*x) for x in extra])
        names = schema.names
        self.rows = stored(dealt.mapInArrow(lambda batches: _runs(batches, names), schema), new_folder(docs.sparkSession, "sorted"))
        self.starts = self._starts()

    def _starts(self) -> DataFrame:
        """For each range that goes on with a run of the one before it: where that run
        began. One small row for each range at most."""
        spark, part, run, edge, text = self.rows.sparkSession, *map(F.col, (self.part, self.run, self.edge, self.text))
        lasts = self.rows.where(edge.bitwiseAND(F.lit(_LAST)) > 0).select(part.alias("part"), run.alias("run"), text.alias("text"))
        firsts = self.rows.where(edge.bitwiseAND(F.lit(_FIRST)) > 0).select(part.alias("next"), text.alias("other"))
        ends = sorted((r["part"], r["run"]) for r in lasts.select("part", "run").collect())
        follows = [(a, b) for (a, _), (b, _) in zip(ends, ends[1:], strict=False)]
        after = spark.createDataFrame(follows, "part int, next int")
        met = lasts.join(F.broadcast(after), "part").join(firsts, "next").where("text = other").select("next")
        goes_on = {r["next"] for r in met.collect()}
        out, origin, before = [], None, None
        for at, last in ends:
            if at in goes_on:
                # ``before`` is the last run of the range before, or where that one began.
                origin = before
                out.append((at, *origin))
            before = (at, last) if last > 0 or at not in goes_on else origin
        return F.broadcast(spark.createDataFrame(out, "at int, from_part int, from_run long"))

    def joined(self) -> DataFrame:
        """All rows, with the range and the run in which the run of each began as
        ``from_part`` and ``from_run``."""
        starts = self.starts
        rows = self.rows.join(starts, (F.col(self.part) == starts["at"]) & (F.col(self.run) == 0), "left")
        return rows.withColumn("from_part", F.coalesce("from_part", F.col(self.part))).withColumn("from_run", F.coalesce("from_run", F.col(self.run)))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: doc_id, keep_id, group_size, kept, text_sha256."""
    found = Sorted(docs, docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("content")), "doc_id", "content")
    sha = F.lower(F.hex(found.digest)).alias("text_sha256")
    lone = found.rows.where(found.alone).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha
    )
    rest = found.joined().where(~F.col(found.alone)).withColumnsRenamed({found.part: "part", found.run: "run", found.first: "first"})
    # Summed for each run of a range first: no key has more rows than a range, or than there are ranges.
    local = rest.groupBy("part", "run", "from_part", "from_run").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    whole = local.groupBy("from_part", "from_run").agg(F.min("least").alias("keep_id"), F.sum("n").alias("group_size"))
    sized = local.select("part", "run", "from_part", "from_run").join(whole, ["from_part", "from_run"]).select("part", "run", "keep_id", "group_size")
    kept = F.col("first") & (F.col("part") == F.col("from_part")) & (F.col("run") == F.col("from_run"))
    grouped = rest.select("doc_id", kept.alias("kept"), sha, "part", "run").join(sized, ["part", "run"])
    return lone.union(grouped.select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts: that with the smallest id."""
    found = Sorted(docs, docs, id_col, text_col)
    starts = found.starts
    goes_on = (F.col(found.part) == starts["at"]) & (F.col(found.run) == 0)
    return found.rows.where(found.first).join(starts, goes_on, "left_anti").select(docs.columns)
