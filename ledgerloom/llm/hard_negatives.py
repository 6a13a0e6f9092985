"""Hard negatives by exact scores, worked out as the Four Russians do.

Components become whole numbers. A candidate is packed into bit-planes: one byte holds
one bit of eight components, and the planes run from the sign down to the lowest bit. For each
group of eight components an anchor has a table with the sums of all 256 subsets of
its components. The inner product is then, plane by plane, the sum of the table entries that
the candidate's bytes point at, shifted and added: exact, without a multiplication.

All anchors meet all rows, in blocks: ``_grid`` sends every block of anchors to every block of
candidates, a task makes the tables of a block of anchors once and reads the candidates
row by row, and keeps of each anchor a few best. The first round finds the positives, whose
scores give the bounds of the second, which finds the negatives. The blocks of anchors bound
what a task holds whatever the table; a label or a vector of very many rows changes nothing,
as rows are dealt by the hash of their id.

Defined results: rows with a null id, label or vector, or a null or non-finite component take
no part, nor do those with a component that is beyond ``MOST`` once it is a whole number
(scores could leave 64 bits). Vectors of different lengths don't meet; those without
components have scores of 0. Of rows with one id that with the smallest label, then the
smallest vector takes part. No anchors, positives or negatives give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import batched, cut, rows_of

MOST = 1 << 24
#: Anchors to a block, and their tables in bytes at most.
ANCHORS, TABLE_BYTES = 1024, 48 << 20
#: Candidates of a block at least and at most, and rows scored at a time.
LEAST_ROWS, MOST_ROWS = 1024, 1_000_000
CHUNK = 256

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def packed(numbers: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes: two's complement of ``planes`` bits, the sign first."""
    rows, size = numbers.shape
    padded = np.zeros((rows, -(-size // 8) * 8), np.int64)
    padded[:, :size] = numbers
    bits = (padded[:, None, :] >> np.arange(planes - 1, -1, -1)[:, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


class Tables:
    """Sums of the subsets of eight components each, for a block of anchors."""

    def __init__(self, numbers: np.ndarray, largest: int):
        """``largest`` bounds every component, also those of candidates."""
        anchors, size = numbers.shape
        # 32 bits where no score and no sum on the way to it can leave them.
        self.kind = np.int32 if size * max(largest, 1) ** 2 < 1 << 29 else np.int64
        groups = -(-size // 8)
        padded = np.zeros((anchors, groups * 8), np.int64)
        padded[:, :size] = numbers
        self.sums = [(_BITS @ padded[:, 8 * g : 8 * g + 8].T).astype(self.kind) for g in range(groups)]
        self.anchors = anchors

    def scores(self, planes: np.ndarray, only: np.ndarray | None = None) -> np.ndarray:
        """(rows, anchors) for packed rows, of all anchors or those at the places ``only``."""
        tables = self.sums if only is None else [sums[:, only] for sums in self.sums]
        total = np.zeros((len(planes), self.anchors if only is None else len(only)), self.kind)
        for b in range(planes.shape[1]):
            total <<= 1
            for g, sums in enumerate(tables):
                # The sign's plane counts negative.
                (np.subtract if b == 0 else np.add)(total, sums[planes[:, b, g]], out=total)
        return total


class Best:
    """The ``k`` best rows of each of ``slots`` lists; rows must come by rising id."""

    def __init__(self, slots: int, k: int):
        self.k, self.floor = k, np.full(slots, np.iinfo(np.int64).min)
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Rows that may belong to the lists: their scores are above ``floor``."""
        if not len(slot):
            return
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        nth = np.arange(len(slot)) - np.searchsorted(slot, slot)
        good = nth < self.k
        self.slot, self.score, self.id = slot[good], score[good], ids[good]
        # Of a full list; what comes later with the same score has a larger id.
        full = nth == self.k - 1
        self.floor[slot[full]] = score[full]


def whole(component: Column, factor: int) -> Column:
    return F.floor(component.cast("double") * factor)


def _usable(vectors: DataFrame, id_col: str, label: Column, vec_col: str, factor: int) -> DataFrame:
    """(id, label, vec): whole components, one row for each id."""
    vec = F.col(vec_col).cast("array<double>")
    fine = F.forall(vec, lambda x: F.coalesce(F.abs(x * factor) < F.lit(float(MOST)), F.lit(False)))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"), vec.alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & fine)
    rows = rows.select("id", F.struct("label", F.transform("vec", lambda x: whole(x, factor).cast("int")).alias("vec")).alias("row"))
    return rows.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.vec")


def _binary(rows: DataFrame, planes: int, anchor: Column) -> DataFrame:
    """(id, label, size, anchor, bytes, numbers): the packed planes of every row, and the
    components of anchors."""
    rows = rows.select("id", "label", "vec", F.coalesce(anchor, F.lit(False)).alias("anchor"))
    kind = pa.schema([
        ("id", pa.int64()), ("label", pa.string()), ("size", pa.int32()), ("anchor", pa.bool_()), ("bytes", pa.binary()), ("numbers", pa.binary())
    ])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, asks = batch.column("vec"), batch.column("anchor").to_pylist()
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32), np.cumsum(sizes)
            vectors = [flat[end - size : end] for size, end in zip(sizes, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("label"), pa.array(sizes, pa.int32()), batch.column("anchor"),
                    pa.array([packed(v[None], planes).tobytes() for v in vectors], pa.binary()),
                    pa.array([v.astype("<i4").tobytes() if a else None for v, a in zip(vectors, asks, strict=True)], pa.binary()),
                ],
                schema=kind,
            )

    return rows.mapInArrow(pack, "id long, label string, size int, anchor boolean, bytes binary, numbers binary")


def _grid(anchors: DataFrame, rows: DataFrame, tasks: int, *order: str) -> DataFrame:
    """Every block of anchors with every block of rows of its size: (size, i, j, row) with the
    anchors first. ``anchors`` has (size, id, label, data, bounds), ``rows`` (size, id, label, data)."""
    asked = anchors.groupBy("size").agg(F.count("*").alias("asked"))
    # Distinct lengths of vectors are few; the join is left to Spark's size checks all the same.
    sizes = rows.groupBy("size").agg(F.count("*").alias("rows")).join(asked, "size")
    room = F.floor(F.lit(TABLE_BYTES) / (F.ceil(F.col("size") / 8) * 256 * 8 + 1))
    blocks = F.ceil(F.col("asked") / F.greatest(F.lit(1), F.least(F.lit(ANCHORS), room))).cast("int")
    wanted = F.least(F.ceil(F.lit(2 * tasks) / F.col("is")), F.ceil(F.col("rows") / LEAST_ROWS))
    sizes = sizes.withColumn("is", blocks).withColumn("js", F.greatest(F.lit(1), wanted, F.ceil(F.col("rows") / MOST_ROWS)).cast("int"))
    sizes = cut(sizes.select("size", "is", "js"))

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    def one(count: str, seed: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.col(count)).cast("int")

    own = ["id", "label", "data"]
    left = anchors.join(sizes, "size").select("size", one("is", 0).alias("i"), every("js").alias("j"), F.lit(0).alias("tag"), *own, "bounds")
    right = rows.join(sizes, "size").select("size", every("is").alias("i"), one("js", 1).alias("j"), F.lit(1).alias("tag"), *own)
    both = left.unionByName(right, allowMissingColumns=True)
    return both.repartition(tasks, "size", "i", "j").sortWithinPartitions("size", "i", "j", "tag", *order)


class Block:
    """The anchors of a cell, and the best rows found for them."""

    def __init__(self, size: int, anchors: list[tuple], largest: int, bands: int, k: int):
        self.size, self.ids = size, np.array([a[0] for a in anchors], np.int64)
        self.labels = np.array([a[1] for a in anchors], object)
        self.tables = Tables(np.array([np.frombuffer(a[2], "<i4") for a in anchors], np.int64).reshape(len(anchors), size), largest)
        #: (anchors, bands): the bounds of the scores, and the id that each band is for.
        self.low, self.high = np.full((len(anchors), bands), 1, np.int64), np.zeros((len(anchors), bands), np.int64)
        self.named = [a[3] or [] for a in anchors]
        for at, own in enumerate(self.named):
            for band, bound in enumerate(own):
                self.low[at, band], self.high[at, band] = bound["low"], bound["high"]
        self.best = Best(len(anchors) * bands, k)

    def unpacked(self, chunk: list[tuple], planes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.array([c[0] for c in chunk], np.int64)
        labels = np.array([c[1] for c in chunk], object)
        data = np.frombuffer(b"".join(c[2] for c in chunk), np.uint8)
        return ids, labels, data.reshape(len(chunk), planes, -(-self.size // 8))

    def positives(self, chunk: list[tuple], planes: int) -> None:
        """Rows of one label come together, so few anchors fit a chunk."""
        ids, labels, data = self.unpacked(chunk, planes)
        for label in dict.fromkeys(labels):
            mine, theirs = np.flatnonzero(self.labels == label), labels == label
            if not len(mine):
                continue
            score = self.tables.scores(data[theirs], mine)
            good = (score > self.best.floor[mine]) & (ids[theirs][:, None] != self.ids[mine])
            row, slot = np.nonzero(good)
            self.best.add(mine[slot], score[row, slot].astype(np.int64), ids[theirs][row])

    def negatives(self, chunk: list[tuple], planes: int) -> None:
        ids, labels, data = self.unpacked(chunk, planes)
        score, bands = self.tables.scores(data), self.low.shape[1]
        other = labels[:, None] != self.labels
        floor = self.best.floor.reshape(self.low.shape)
        slots, scores, found = [], [], []
        for band in range(bands):
            low = np.maximum(self.low[:, band], floor[:, band] + (floor[:, band] > np.iinfo(np.int64).min))
            row, at = np.nonzero((score >= low) & (score <= self.high[:, band]) & other)
            slots.append(at * bands + band)
            scores.append(score[row, at].astype(np.int64))
            found.append(ids[row])
        self.best.add(*(np.concatenate(x) for x in (slots, scores, found)))


def _swept(
    cells: DataFrame, planes: int, largest: int, bands: int, k: int, step: Callable[[Block, list[tuple], int], None], schema: pa.Schema,
    told: Callable[[Block], Iterator[tuple]], ddl: str,
) -> DataFrame:
    """``step`` for the candidates of each cell, chunk by chunk; ``told`` gives its rows."""
    columns = ["size", "i", "j", "tag", "id", "label", "data", "bounds"]

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            at, anchors, block, chunk = None, [], None, []

            def ended() -> Iterator[tuple]:
                if block and chunk:
                    step(block, chunk, planes)
                if block:
                    yield from told(block)

            for size, i, j, tag, *row in rows_of(batches, *columns):
                if (size, i, j) != at:
                    yield from ended()
                    at, anchors, block, chunk = (size, i, j), [], None, []
                if tag == 0:
                    anchors.append(row)
                elif anchors:
                    block = block or Block(size, anchors, largest, bands, k)
                    chunk.append(row)
                    if len(chunk) == CHUNK:
                        step(block, chunk, planes)
                        chunk = []
            yield from ended()

        yield from batched(out(), schema)

    return cells.mapInArrow(sweep, ddl)


def mine(
    vectors: DataFrame, anchors: Column, label: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    factor: int = 256, id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """For each row where ``anchors`` holds (a condition on ``id``) and each of its ``positives``
    nearest rows of the same label, the ``negatives`` nearest of other labels whose score is
    ``low`` to ``high`` % of the positive's. The score is the inner product of the
    components times ``factor``, rounded down."""
    spark = vectors.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    usable = _usable(vectors, id_col, label, vec_col, factor)
    usable = cut(usable)
    largest = usable.agg(F.max(F.array_max(F.transform("vec", F.abs)))).first()[0] or 0
    planes = int(largest).bit_length() + 1
    rows = cut(_binary(usable, planes, anchors))
    asking = rows.where("anchor").select("size", "id", "label", F.col("numbers").alias("data"))
    candidates = rows.select("size", "id", "label", F.col("bytes").alias("data"))
    bounds = "array<struct<id:long,score:long,low:long,high:long>>"

    first = _grid(asking.withColumn("bounds", F.lit(None).cast(bounds)), candidates, tasks, "label", "id")
    kind = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
    near = _swept(
        first, planes, largest, 1, positives, Block.positives, kind,
        lambda b: zip(b.ids[b.best.slot].tolist(), b.best.id.tolist(), b.best.score.tolist(), strict=True),
        "anchor_id long, positive_id long, positive_score long",
    )
    place = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("nth", F.row_number().over(place)).where(F.col("nth") <= positives)
    # Whole numbers: low * positive <= 100 * negative <= high * positive.
    least = F.ceil(F.col("positive_score").cast("decimal(38,0)") * low / 100)
    most = F.floor(F.col("positive_score").cast("decimal(38,0)") * high / 100)
    bound = F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"), least.cast("long").alias("low"), most.cast("long").alias("high"))
    bounded = near.where(least <= most).groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(bound).cast(bounds).alias("bounds"))
    bounded = cut(asking.join(bounded, "id").select("size", "id", "label", "data", "bounds"))

    kind = pa.schema([(c, pa.int64()) for c in ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")])

    def told(b: Block) -> Iterator[tuple]:
        bands = b.low.shape[1]
        for slot, score, other in zip(b.best.slot.tolist(), b.best.score.tolist(), b.best.id.tolist(), strict=True):
            own = b.named[slot // bands][slot % bands]
            yield int(b.ids[slot // bands]), own["id"], other, own["score"], score

    found = _swept(
        _grid(bounded, candidates, tasks, "id"), planes, largest, positives, negatives, Block.negatives, kind, told,
        "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long",
    )
    place = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
