"""Approximate nearest neighbours by cross-polytope hashing.

Three rounds of random signs and a fast Hadamard transform turn a vector; its hash is the
nearest signed axis. A vector has ``HASHES`` hashes of different rotations, which together are
its key: far more keys than rows, however many rows there are. The first few hashes are
also the buckets of tables, each of which holds every vector.

A query probes the buckets of its largest signed components, in one or more tables. Of the keys it
meets there only those are looked at whose joint loss is small: the sum of the query's
components on the axes of the key, as a share of the query's length, reaches a bound.
Their vectors are ranked by exact inner products. How many tables and buckets are probed and
the bound are fitted: ``FITTED`` queries (a fixed number, chosen by the hash of their ids) are
compared with all rows, and the least work is taken that finds ``WANTED`` of their nearest rows.
So the work follows the data: where neighbours are near, few buckets and keys are enough.

The largest inner product is the nearest direction once every vector gets a component
that lifts it to the largest norm, and queries a zero there; that is done where the norms
differ. A bucket of many vectors is cut into parts of bounded size; a query visits all
parts, and the queries of a bucket are dealt into parts of bounded size as well. Of equal
vectors only the first ``k + 1`` ids are indexed: the others can be
nobody's k nearest, as ties go to the smaller id.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
take no part, nor do rows without an id; vectors of different lengths never meet; a repeated id is
one candidate for each distinct vector; a query that met fewer than ``k`` vectors searches all
buckets and keys; an empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerloom.llm.common import cut

HASHES, MOST_TABLES, PART = 12, 4, 4000
FITTED, WANTED = 100, 0.965
SEED = 5


class Rotations:
    """Pseudo-random rotations of vectors of one length, by hash."""

    def __init__(self, length: int, lift: bool, seed: int = SEED):
        self.size, self.lift, self.seed = 1, lift, seed
        while self.size < length + lift:
            self.size *= 2

    def padded(self, vectors: np.ndarray, top: float) -> np.ndarray:
        """Zero-padded; with the lift of each vector to the norm ``top`` if there is one."""
        out = np.zeros((len(vectors), self.size))
        out[:, : vectors.shape[1]] = vectors
        if self.lift and top > 0:
            out[:, vectors.shape[1]] = np.sqrt(np.maximum(top**2 - (vectors**2).sum(axis=1), 0))
        return out

    def turned(self, padded: np.ndarray, nth: int) -> np.ndarray:
        signs = np.random.default_rng([self.seed, self.size, nth]).choice([-1.0, 1.0], (3, self.size))
        for sign in signs:
            padded, step = padded * sign, 1
            while step < self.size:
                pairs = padded.reshape(len(padded), -1, 2, step)
                padded = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(len(padded), self.size)
                step *= 2
        return padded

    def signed(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Of each hash the components on all signed axes, as shares of the vector's length."""
        padded = self.padded(vectors, 0.0)
        padded /= np.maximum(np.linalg.norm(padded, axis=1, keepdims=True), 1e-300)
        turned = (self.turned(padded, nth) / self.size**1.5 for nth in range(HASHES))
        return [np.concatenate((t, -t), axis=1) for t in turned]

    def keys(self, vectors: np.ndarray, top: float) -> np.ndarray:
        """The nearest signed axis by hash, a row for each vector."""
        padded = self.padded(vectors, top)
        out = np.zeros((len(vectors), HASHES), np.int32)
        for nth in range(HASHES):
            turned = self.turned(padded, nth)
            out[:, nth] = np.argmax(np.concatenate((turned, -turned), axis=1), axis=1)
        return out


class Probe(NamedTuple):
    """How a query looks: in how many tables, in how many buckets of each, and the bound of the joint loss."""

    tables: int
    buckets: int
    bound: float


def joint(signed: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """(queries, vectors): the sum of the queries' components on the axes of the keys."""
    total = np.zeros((len(signed[0]), len(keys)))
    for nth, own in enumerate(signed):
        total += own[:, keys[:, nth]]
    return total


def places(own: np.ndarray) -> np.ndarray:
    """The place of each axis among those of a query, largest first."""
    order = np.argsort(-own, axis=1, kind="stable")
    out = np.empty_like(order)
    np.put_along_axis(out, order, np.arange(own.shape[1])[None], axis=1)
    return out


def fitted(losses: np.ndarray, ranks: np.ndarray, axes: int) -> Probe:
    """The least work that finds ``WANTED`` of the pairs of query and true neighbour, of which the
    joint losses and, by table, the place of the neighbour's bucket for the query are given.
    Of what may be missed a third is left to the buckets."""
    best, spare = Probe(1, axes, -np.inf), 1 - WANTED
    if not len(losses):
        return best
    for tables in range(1, MOST_TABLES + 1):
        place = np.sort(ranks[:, :tables].min(axis=1))
        buckets = int(place[len(place) - 1 - int(len(place) * spare / 3)]) + 1
        if tables * buckets < best.tables * best.buckets:
            best = Probe(tables, buckets, -np.inf)
    met = np.sort(losses[ranks[:, : best.tables].min(axis=1) < best.buckets])
    lost = int(len(losses) * spare) - (len(losses) - len(met))
    # A little less than the loss itself, which is rounded in another order elsewhere.
    return best._replace(bound=float(met[max(0, lost)]) - 1e-9)


def usable(column: Column) -> Column:
    """A vector that takes part."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(column) > 0) & ~bad & F.exists(column, lambda x: x != 0), F.lit(False))


def _keyed(rows: DataFrame, lift: bool, top: float) -> DataFrame:
    """``rows`` with their keys."""
    schema = T.StructType([*rows.schema.fields, T.StructField("keys", T.ArrayType(T.IntegerType()))])

    def key(batches):
        for batch in batches:
            for length, some in batch.groupby("size"):
                vectors = np.stack(some["vec"].to_numpy())
                yield some.assign(keys=list(Rotations(int(length), lift).keys(vectors, top)))

    return rows.mapInPandas(key, schema)


def _products(asked: np.ndarray, table: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Exact inner products of pairs, some at a time."""
    out = np.empty(len(row))
    for at in range(0, len(row), 100_000):
        some = slice(at, at + 100_000)
        out[some] = (asked[row[some]] * table[column[some]]).sum(axis=1)
    return out


def _ranked(vectors: pd.DataFrame, queries: pd.DataFrame, k: int, lift: bool, probes: dict[int, Probe]) -> pd.DataFrame:
    """The k nearest of one part for each of its queries, by exact inner products of what passes the bound."""
    if vectors.empty or queries.empty:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    table, ids = np.stack(vectors["vec"].to_numpy()).astype(float), vectors["id"].to_numpy()
    keys, length, tab = np.stack(vectors["keys"].to_numpy()), table.shape[1], int(vectors["tab"].iloc[0])
    probe, out = probes[length], []
    for at in range(0, len(queries), 256):
        some = queries.iloc[at : at + 256]
        asked, own = np.stack(some["vec"].to_numpy()).astype(float), some["id"].to_numpy()
        good = own[:, None] != ids
        if tab >= 0:
            signed = Rotations(length, lift).signed(asked)
            good &= joint(signed, keys) >= probe.bound
            for before in range(tab):
                # What a query meets in several tables it compares in the first of them.
                good &= places(signed[before])[:, keys[:, before]] >= probe.buckets
        row, column = np.nonzero(good)
        score = _products(asked, table, row, column)
        order = np.lexsort((ids[column], -score, row))
        row, column, score = row[order], column[order], score[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        best = nth < k
        out.append(pd.DataFrame({"query_id": own[row[best]], "vec_id": ids[column[best]], "score": score[best]}))
    return pd.concat(out)


def _fit(index: DataFrame, want: DataFrame, k: int, lift: bool) -> dict[int, Probe]:
    """A probe for each length of vectors. ``FITTED`` queries of each are compared with all rows; every
    task hands on its ``k`` nearest of each."""
    chosen = want.withColumn("nth", F.row_number().over(W.partitionBy("size").orderBy(F.xxhash64("id", F.lit(3)), "id")))
    asked = {}
    # Bounded by the lengths of vectors that occur.
    for r in chosen.where(F.col("nth") <= FITTED).select("size", "id", "vec").collect():
        asked.setdefault(r["size"], []).append((r["id"], r["vec"]))
    asked = {size: (np.array([i for i, _ in own]), np.array([v for _, v in own], float)) for size, own in asked.items()}
    columns = "size int, query int, id long, score double, keys array<int>"

    def nearest(batches):
        kept: dict[int, pd.DataFrame] = {}
        for batch in batches:
            for size, some in batch.groupby("size"):
                if size not in asked:
                    continue
                own, vectors = asked[size]
                near = vectors @ np.stack(some["vec"].to_numpy()).astype(float).T
                near[own[:, None] == some["id"].to_numpy()] = -np.inf
                least = np.partition(near, -min(k, near.shape[1]), axis=1)[:, -min(k, near.shape[1])]
                row, column = np.nonzero((near >= least[:, None]) & np.isfinite(near))
                found = pd.DataFrame({"size": size, "query": row, "id": some["id"].to_numpy()[column], "score": near[row, column], "keys": some["keys"].to_numpy()[column]})
                found = pd.concat([kept[size], found]) if size in kept else found
                kept[size] = found.sort_values(["query", "score"], ascending=[True, False]).groupby("query").head(k)
        yield from (found.astype({"size": "int32", "query": "int32"}) for found in kept.values())

    met = index.select("size", "id", "vec", "keys").mapInPandas(nearest, columns)
    place = F.row_number().over(W.partitionBy("size", "query").orderBy(F.desc("score"), "id"))
    true = met.withColumn("nth", place).where(F.col("nth") <= k).toPandas()
    out = {}
    for size, (_, vectors) in asked.items():
        turn, own = Rotations(size, lift), true[true["size"] == size]
        signed = turn.signed(vectors)
        query = own["query"].to_numpy()
        keys = np.stack(own["keys"].to_numpy()) if len(own) else np.zeros((0, HASHES), int)
        losses = sum(signed[n][query, keys[:, n]] for n in range(HASHES)) if len(own) else np.zeros(0)
        ranks = np.stack([places(signed[n])[query, keys[:, n]] for n in range(MOST_TABLES)], axis=1)
        out[size] = fitted(losses, ranks, 2 * turn.size)
    return out


def search(
    vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", part: int = PART
) -> DataFrame:
    """For each row where ``queries`` holds, its ``k`` nearest other rows:
    query_id, rank, vec_id, score."""
    # Negative zero counts as zero, or equal vectors would differ.
    vec = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), vec.alias("vec"), F.coalesce(queries, F.lit(False)).alias("asks")
    ).where(F.col("id").isNotNull() & usable(F.col("vec")))
    rows = cut(rows.withColumn("norm", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda n, x: n + x * x))))
    low, top = rows.agg(F.min("norm"), F.max("norm")).first()
    lift = bool(top) and low < top * (1 - 1e-4)

    ordered = W.partitionBy("vec").orderBy("id")
    plain = rows.select("id", "vec", F.size("vec").alias("size"))
    index = plain.distinct().withColumn("nth", F.row_number().over(ordered)).where(F.col("nth") <= k + 1).drop("nth")
    index = cut(_keyed(index, lift, top or 0.0))
    want = cut(rows.where("asks").select("id", "vec", F.size("vec").alias("size")).distinct())
    probes = _fit(index, want, k, lift)
    cell = ["size", "tab", "axis"]

    def met(tabled: DataFrame, probed: DataFrame) -> DataFrame:
        """What the queries meet, ``part`` queries of a cell with ``part`` vectors of it at a time."""
        # Bounded by tables, vector lengths and their axes, both of them.
        cells = tabled.groupBy(*cell).agg(F.ceil(F.count("*") / F.lit(part)).cast("int").alias("parts"))
        many = probed.groupBy(*cell).agg(F.ceil(F.count("*") / F.lit(part)).cast("int").alias("turns"))
        sizes = F.broadcast(cut(cells.join(many, cell)))

        def every(count: str) -> Column:
            return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

        shown = tabled.join(sizes, cell).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        asked = probed.join(sizes, cell).withColumn("turn", F.pmod(F.xxhash64("id", F.lit(1)), F.col("turns")).cast("int"))
        places = [*cell, "part", "turn"]
        shown, asked = shown.withColumn("turn", every("turns")), asked.withColumn("part", every("parts"))
        return shown.groupBy(places).cogroup(asked.groupBy(places)).applyInPandas(
            lambda v, q: _ranked(v, q, k, lift, probes), "query_id long, vec_id long, score double"
        )

    def probing(batches):
        for batch in batches:
            for length, some in batch.groupby("size"):
                probe, signed = probes[int(length)], Rotations(int(length), lift).signed(np.stack(some["vec"].to_numpy()))
                for tab in range(probe.tables):
                    order = np.argsort(-signed[tab], axis=1, kind="stable")
                    for nth in range(min(probe.buckets, order.shape[1])):
                        yield some.assign(tab=np.int32(tab), axis=order[:, nth].astype(np.int32))

    # Where every bucket of one table is probed, no buckets are needed.
    whole = [size for size, p in probes.items() if p.tables == 1 and p.buckets == 2 * Rotations(size, lift).size]
    tables = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for s, p in probes.items() for x in (s, p.tables))), F.col("size")), F.lit(0)) if probes else F.lit(0)
    bucketed = index.withColumn("tab", F.explode(F.filter(F.sequence(F.lit(0), F.lit(MOST_TABLES - 1)), lambda t: t < tables)))
    bucketed = bucketed.withColumn("axis", F.when(F.col("size").isin(whole), -1).otherwise(F.get("keys", F.col("tab"))))
    schema = T.StructType([*want.schema.fields, T.StructField("tab", T.IntegerType()), T.StructField("axis", T.IntegerType())])
    probed = want.where(~F.col("size").isin(whole)).mapInPandas(probing, schema)
    probed = probed.union(want.where(F.col("size").isin(whole)).select("*", F.lit(0).alias("tab"), F.lit(-1).alias("axis")))
    nearest = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(met: DataFrame) -> DataFrame:
        # The same candidate under one id twice has the same score or another vector.
        return met.withColumn("rank", F.dense_rank().over(nearest)).where(F.col("rank") <= k).distinct()

    found = cut(best(met(bucketed, probed)))
    fed = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    hungry = cut(want.join(fed.withColumnRenamed("query_id", "id"), "id", "left_anti"))
    if hungry.limit(1).count():
        # All rows, without a bound.
        everywhere = [F.lit(-1).alias("tab"), F.lit(-1).alias("axis")]
        more = best(met(index.select("*", *everywhere), hungry.select("*", *everywhere)))
        found = best(found.drop("rank").union(more.drop("rank")))
    return found.select("query_id", "rank", "vec_id", "score")
