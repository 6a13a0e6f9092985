"""Near-duplicate groups by MinHash and a multi-index Hamming join.

A document's set of word shingles gets 40 MinHash values, each kept to 11 bits: eight
chunks of five symbols, a chunk in one long with 12 bits a symbol. Two signatures that
differ in at most 15 symbols have, by the pigeonhole principle, a chunk that differs in
at most one. So every chunk is entered in five buckets, each with another symbol masked
out, and all pairs under that distance meet in a bucket. At a similarity of 0.8 a pair has 8
different symbols on average; it meets in no bucket with a chance of 2e-5. What
meets is compared on whole signatures, on a parity sketch and on the full sets. The parity
sketch has 512 bits, each the parity of the shingles that hash to it: two sets differ in at
least as many shingles as their sketches in bits, so it only rules out pairs that are no link.

Texts with equal sets are one class (a 64-bit hash of the set, with its size). Groups of
near copies are not expanded into pairs: every class is first compared with one pivot
of each of its buckets, what links is joined into components, and this is repeated with
another pivot if many pairs of one bucket are in different components. Then
all pairs that are left are compared, so every link between components is found.

Defined results: no text or no word: an empty set, its own component, kept; a single
word is a set of one; rows that share a document id are one document with
several texts; a null id is smaller than none, so a group has a null component id
only if all its ids are null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batched, cut, free_name, held, rows_of
from ledgerloom.llm.components import components

CHUNKS, SYMBOLS, LANE, BITS = 8, 5, 12, 11
GUARANTEED = 2 * CHUNKS - 1
#: Signatures further apart than this are not compared on their sets: 6 deviations at 0.8.
FAR = 23
PIVOT_ROUNDS = 1
PARITY_LONGS = 8
_SEED = 77
_BLOCK = 4096
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_SPACE = b"\t\n\x0b\x0c\r "


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[2])
    return x ^ (x >> np.uint64(31))


class Sketcher:
    """Texts to sets of hashed shingles, and sets to signatures."""

    def __init__(self, size: int):
        draws = np.random.default_rng(_SEED)
        self.size = size
        self.times = draws.integers(0, 1 << 63, CHUNKS * SYMBOLS, np.uint64) * np.uint64(2) + np.uint64(1)
        self.plus = draws.integers(0, 1 << 63, CHUNKS * SYMBOLS, np.uint64)
        self.space = np.isin(np.arange(256), list(_SPACE))
        self.powers = np.ones(1, np.uint64)

    def _powers(self, length: int) -> np.ndarray:
        if len(self.powers) < length:
            steps = np.full(2 * length, _MIX[0], np.uint64)
            steps[0] = 1
            self.powers = np.cumprod(steps, dtype=np.uint64)
        return self.powers

    def words(self, text: str) -> np.ndarray:
        """A 64-bit hash of each word, a polynomial in its bytes."""
        data = np.frombuffer(b" " + text.encode().lower() + b" ", np.uint8)
        edge = np.flatnonzero(np.diff(self.space[data]))
        starts, ends = edge[::2] + 1, edge[1::2] + 1
        if not len(starts):
            return np.zeros(0, np.uint64)
        lengths = ends - starts
        first = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum()) - np.repeat(first, lengths)
        values = (data[~self.space[data]].astype(np.uint64) + np.uint64(1)) * self._powers(int(lengths.max()))[place]
        return _mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64))

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted hashes of the distinct shingles."""
        words = self.words(text) if text else np.zeros(0, np.uint64)
        if not len(words):
            return words
        size = min(self.size, len(words))
        runs = np.full(len(words) - size + 1, size, np.uint64)
        for at in range(size):
            runs = (runs * np.uint64(_MIX[0])) ^ _mixed(words[at : len(words) - size + 1 + at] + np.uint64(at))
        return np.unique(_mixed(runs))

    def signature(self, shingles: np.ndarray) -> list[int]:
        low = np.full(CHUNKS * SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), _BLOCK):
            block = shingles[at : at + _BLOCK, None] * self.times + self.plus
            np.minimum(low, (block ^ (block >> np.uint64(32))).min(axis=0), out=low)
        symbols = (_mixed(low) >> np.uint64(64 - BITS)).reshape(CHUNKS, SYMBOLS)
        lanes = symbols << (np.arange(SYMBOLS, dtype=np.uint64) * np.uint64(LANE))
        return np.bitwise_or.reduce(lanes, axis=1).astype(np.int64).tolist()

    def parity(self, shingles: np.ndarray) -> list[int]:
        bits = 64 * PARITY_LONGS
        odd = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).tolist()


_CHUNK_NAMES = [f"c{i}" for i in range(CHUNKS)]
_PARITY_NAMES = [f"p{i}" for i in range(PARITY_LONGS)]
_SIGNATURE = ("n", *_CHUNK_NAMES, *_PARITY_NAMES)


def sketches(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, tag (hash of the text), node (hash of the set, null if empty), n, the chunks
    of the signature and the parity sketch."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    names = ["doc_id", "tag", "node", *_SIGNATURE]
    kind = pa.schema([(name, pa.int64()) for name in names])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(("sketcher", size), lambda: Sketcher(size))

        def out() -> Iterator[tuple]:
            for doc, tag, text in rows_of(batches, "doc_id", "tag", "text"):
                found = own.shingles(text)
                if len(found):
                    node = xxhash.xxh3_64_intdigest(found.tobytes(), len(found))
                    yield doc, tag, node - (1 << 63), len(found), *own.signature(found), *own.parity(found)
                else:
                    yield doc, tag, None, 0, *[None] * (CHUNKS + PARITY_LONGS)

        yield from batched(out(), kind)

    return rows.mapInArrow(sketch, ", ".join(f"{name} long" for name in names))


def _lane(i: int) -> int:
    return ((1 << LANE) - 1) << (i * LANE)


def _apart(a: Column, b: Column) -> Column:
    """How many symbols of two chunks differ. Adding all ones of 11 bits to a lane
    that isn't 0 carries into its 12th bit."""
    ones = sum(((1 << BITS) - 1) << (i * LANE) for i in range(SYMBOLS))
    tops = sum(1 << (i * LANE + BITS) for i in range(SYMBOLS))
    return F.bit_count((a.bitwiseXOR(b) + F.lit(ones)).bitwiseAND(F.lit(tops)))


def _distance(left: str, right: str) -> Column:
    return reduce(lambda x, y: x + y, (_apart(F.col(f"{left}.{c}"), F.col(f"{right}.{c}")) for c in _CHUNK_NAMES))


def _comparable(left: str, right: str, percent: int) -> Column:
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    odd = (F.bit_count(F.col(f"{left}.{p}").bitwiseXOR(F.col(f"{right}.{p}"))) for p in _PARITY_NAMES)
    differ = reduce(lambda x, y: x + y, odd)
    return (
        (F.least(a, b) * 100 >= F.greatest(a, b) * percent)
        & (differ * (100 + percent) <= (a + b) * (100 - percent))
        & (_distance(left, right) < FAR)
    )


def _taken_here(left: str, right: str) -> Column:
    """Of the buckets in which a pair meets it is taken up in one: that of its first chunk
    with at most one difference, and of its lanes the one that differs, or lane 0. In
    their bucket the two rows agree on the chunk but for its lane."""
    chunk, lane = F.floor(F.col(f"{left}.cell") / SYMBOLS), F.col(f"{left}.cell") % SYMBOLS
    before = ((chunk <= i) | (_apart(F.col(f"{left}.c{i}"), F.col(f"{right}.c{i}")) > 1) for i in range(CHUNKS - 1))
    differs = F.col(f"{left}.own") != F.col(f"{right}.own")
    return reduce(lambda x, y: x & y, before, (lane == 0) | differs)


def _entries(classes: DataFrame) -> DataFrame:
    """(node, cell, key): the buckets of each class; a cell is a chunk and its masked lane."""
    keys = [
        F.xxhash64(F.col(f"c{i}").bitwiseAND(F.lit(~_lane(j))), F.lit(i * SYMBOLS + j)) for i in range(CHUNKS) for j in range(SYMBOLS)
    ]
    return classes.select("node", F.posexplode(F.array(*keys)).alias("cell", "key"))


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    rows = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    rows = rows.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(("sketcher", size), lambda: Sketcher(size))

        def out() -> Iterator[tuple]:
            last, right = None, None
            for a, b, text_a, text_b in rows_of(batches, "a", "b", "text_a", "text_b"):
                left = own.shingles(text_a)
                if b != last:
                    last, right = b, own.shingles(text_b)
                common = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * common >= percent * (len(left) + len(right) - common):
                    yield a, b

        yield from batched(out(), kind)

    return rows.mapInArrow(confirm, "a long, b long")


def _pairs_with(pivots: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The (node, pivot) pairs whose signatures are near, as (a, b)."""
    met = pivots.where("node <> pivot").distinct()
    near = met.join(classes.alias("x"), "node").join(classes.withColumnRenamed("node", "pivot").alias("y"), "pivot")
    return near.where(_comparable("x", "y", percent)).select(F.col("node").alias("a"), F.col("pivot").alias("b"))


def groups(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Link texts whose sets of ``size``-word shingles have at least ``percent`` % in common.
    Returns (doc_id, tag, n, node) of all rows, and (node, root) of all classes."""
    rows = cut(sketches(docs, size, id_col, text_col))
    classes = rows.where("node is not null").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("of"),
        *(F.first(c).alias(c) for c in _SIGNATURE),
    )
    classes = cut(classes, rows.count())
    total = classes.count()
    most = total * CHUNKS * SYMBOLS
    entries = _entries(classes)
    shared = entries.groupBy("key").agg(F.count("*").alias("met"), F.min("node").alias("pivot")).where("met > 1")
    members = cut(entries.join(shared.select("key", "pivot"), "key"), most)
    involved = members.select("node").distinct().join(classes, "node").select("node", "of.doc_id", "of.tag")
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    found = source.alias("s").join(
        involved.alias("i"), (F.col("s.tag") == F.col("i.tag")) & F.col("s.doc_id").eqNullSafe(F.col("i.doc_id"))
    )
    # A file for each shuffle partition: these rows hold texts.
    texts = cut(found.groupBy("i.node").agg(F.min("s.text").alias("text")))
    signatures = classes.select("node", *_SIGNATURE)

    # A row of ``members`` gives a pair at most.
    links = cut(_confirmed(_pairs_with(members.select("node", "pivot"), signatures, percent), texts, size, percent), most)
    roots = cut(components(links), total)
    for turn in range(PIVOT_ROUNDS + 1):
        marked = members.select("key", "cell", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        by_root = marked.groupBy("key", "root").agg(F.count("*").alias("n"))
        split = by_root.groupBy("key").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("own"), F.count("*").alias("roots"))
        split = cut(split.where("roots > 1"), most)
        left = split.agg(F.sum((F.col("all") * F.col("all") - F.col("own")) / 2)).first()[0] or 0
        marked = cut(marked.join(split.select("key"), "key"), most)
        last = left <= 10 * total or turn == PIVOT_ROUNDS
        if last:
            chunk = F.get(F.array(*_CHUNK_NAMES), F.floor(F.col("cell") / SYMBOLS).cast("int"))
            sides = cut(marked.join(signatures, "node").withColumn("own", chunk), most)
            near = sides.alias("x").join(
                sides.alias("y"),
                (F.col("x.key") == F.col("y.key"))
                & (F.col("x.root") != F.col("y.root"))
                & (F.col("x.node") < F.col("y.node"))
                & _comparable("x", "y", percent)
                & _taken_here("x", "y"),
            )
            pairs = near.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        else:
            # Another pivot of each bucket; it is compared with the other components only.
            chosen = marked.groupBy("key").agg(
                F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), "node", "root")).alias("p")
            )
            met = marked.join(chosen, "key").where(F.col("root") != F.col("p.root"))
            pairs = _pairs_with(met.select("node", F.col("p.node").alias("pivot")), signatures, percent)
        links = cut(_confirmed(pairs, texts, size, percent), int(left) if last else most)
        joined = links.select("a", "b").union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = components(joined)
        if last:
            break
    named = signatures.select("node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return rows.select("doc_id", "tag", "n", "node"), named


def report(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: doc_id, n_shingles, component_id, kept."""
    rows, roots = groups(docs, size, percent, id_col, text_col)
    least = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least")).join(roots, "node")
    smallest = least.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = cut(least.select("node", "root").join(smallest, "root").select("node", "component_id"), rows.count())
    out = rows.join(placed, "node", "left").withColumn(
        "component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    )
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that with the smallest id. Rows without
    words all stay."""
    rows, roots = groups(docs, size, percent, id_col, text_col)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("of")
    best = rows.where("node is not null").groupBy("node").agg(first).join(roots, "node")
    best = best.groupBy("root").agg(F.min("of").alias("of")).select("of.doc_id", "of.tag")
    key, tag = free_name(docs, "key"), free_name(docs, "tag")
    text = F.col(text_col).cast("string")
    source = docs.withColumn(key, F.col(id_col).cast("long")).withColumn(tag, F.xxhash64(text))
    worded = F.coalesce(F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    match = (F.col(f"s.{tag}") == F.col("k.tag")) & F.col(f"s.{key}").eqNullSafe(F.col("k.doc_id"))
    one = source.where(worded).alias("s").join(best.alias("k"), match, "left_semi").dropDuplicates([key, tag])
    return one.unionByName(source.where(~worded)).drop(key, tag)
