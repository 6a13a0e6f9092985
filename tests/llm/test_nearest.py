import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import nearest


def brute(rows, k, asks):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in good:
        if asks(i):
            near = sorted((-float((q * v).sum()), j) for j, v in good if j != i and len(v) == len(q))
            out[i] = [(j, -s) for s, j in near[:k]]
    return out


def found(frame, k, **options):
    got = {}
    for r in nearest.search(frame, F.col("vec_id") % 5 == 0, k=k, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def clusters(n, size, seed, scale=0.0):
    draw = np.random.default_rng(seed)
    middles = draw.normal(size=(12, size))
    rows = middles[draw.integers(0, 12, n)] + 0.4 * draw.normal(size=(n, size))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    return (rows * (1 + scale * draw.random((n, 1)))).astype(np.float32)


@pytest.mark.parametrize("scale", [0.0, 2.0])
def test_recall(table, scale):
    rows = [(i, v.tolist()) for i, v in enumerate(clusters(900, 24, 3, scale))]
    got = found(table(rows, "vec_id long, embedding array<float>"), 10)
    want = brute(rows, 10, lambda i: i % 5 == 0)
    assert got.keys() == want.keys()
    hits = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {i: np.array(v, float) for i, v in rows}
    for i, near in got.items():
        assert all(s == pytest.approx(float(exact[i] @ exact[j]), abs=1e-12) for j, s in near)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))


@pytest.fixture()
def all_found(monkeypatch):
    """A probe that finds every neighbour of every query."""
    monkeypatch.setattr(nearest, "WANTED", 1.0)
    monkeypatch.setattr(nearest, "FITTED", 10_000)


def test_copies_ties_and_parts(table, all_found):
    """A third of all vectors is one vector, in parts of a few rows: ties go to small ids."""
    rows = [(i, v.tolist()) for i, v in enumerate(clusters(200, 8, 4))] + [(1000 + i, [1.0] + [0.0] * 7) for i in range(100)]
    got = found(table(rows, "vec_id long, embedding array<float>"), 7, part=10)
    want = brute(rows, 7, lambda i: i % 5 == 0)
    for i in range(1000, 1100, 5):
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]]
    assert got == {i: [(j, pytest.approx(s, abs=1e-12)) for j, s in near] for i, near in want.items()}


@pytest.mark.parametrize("times", [2, 30])
def test_rows_repeated_more_often_than_k(table, times, all_found):
    """Repeated rows don't use up the places of other ids with the same vector."""
    rows = [(i, v.tolist()) for i, v in enumerate(clusters(40, 8, 6))] + [(1000 + i, [1.0] + [0.0] * 7) for i in range(30)]
    got = found(table(rows * times, "vec_id long, embedding array<float>"), 20)
    want = brute(rows, 20, lambda i: i % 5 == 0)
    assert got == {i: [(j, pytest.approx(s, abs=1e-12)) for j, s in near] for i, near in want.items()}


def test_queries_of_a_cell_are_dealt_into_parts(table, monkeypatch, all_found):
    sizes = table([], "a long").sparkSession.sparkContext.accumulator(0)
    rows = [(i, v.tolist()) for i, v in enumerate(clusters(400, 8, 7))]
    ranked = nearest._ranked

    def watched(vectors, queries, *options):
        sizes.add(int(len(queries) > 40))  # 10 on average, dealt by a hash
        return ranked(vectors, queries, *options)

    monkeypatch.setattr(nearest, "_ranked", watched)
    got = found(table(rows, "vec_id long, embedding array<float>"), 5, part=10)
    assert sizes.value == 0
    assert got == {i: [(j, pytest.approx(s, abs=1e-12)) for j, s in near] for i, near in brute(rows, 5, lambda i: i % 5 == 0).items()}


def work(rows, every=5, k=20):
    """Of all pairs, the share that the fitted probe compares, and how many of the nearest it finds."""
    own = np.array(rows, float)
    asks = np.arange(0, len(own), every)
    turn = nearest.Rotations(own.shape[1], False)
    keys, signed = turn.keys(own, 0.0), turn.signed(own[asks])
    score = own[asks] @ own.T
    score[np.arange(len(asks)), asks] = -np.inf
    near = np.argsort(-score, axis=1)[:, :k]
    ranks = [nearest.places(signed[t]) for t in range(nearest.MOST_TABLES)]
    some = slice(0, nearest.FITTED)
    losses = np.take_along_axis(nearest.joint(signed, keys), near, axis=1)[some].ravel()
    placed = np.stack([np.take_along_axis(r, keys[near, t], axis=1)[some].ravel() for t, r in enumerate(ranks)], axis=1)
    probe = nearest.fitted(losses, placed, 2 * turn.size)
    met = np.zeros(score.shape, bool)
    for table in range(probe.tables):
        met |= ranks[table][:, keys[:, table]] < probe.buckets
    met &= nearest.joint(signed, keys) >= probe.bound
    return met.mean(), np.take_along_axis(met, near, axis=1).mean(), probe


def test_the_share_of_comparisons_falls_with_the_table():
    """Directions without any order, the hardest case."""
    shares = []
    for n in (1000, 4000, 16000):
        rows = np.random.default_rng(n).normal(size=(n, 32))
        share, recall, _ = work(rows / np.linalg.norm(rows, axis=1, keepdims=True), every=n // 200)
        assert recall >= 0.93
        shares.append(share)
    assert shares[0] < 0.5 and shares[2] < 0.5 * shares[0]


def test_near_neighbours_need_few_buckets():
    draw = np.random.default_rng(2)
    middles = draw.normal(size=(300, 32))
    rows = middles[draw.integers(0, 300, 9000)] + 0.1 * draw.normal(size=(9000, 32))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    share, recall, probe = work(rows, every=45)
    assert recall >= 0.93 and share < 0.02 and probe.tables * probe.buckets <= 16


def test_vectors_that_take_no_part(table):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (5, [0.5, 0.5]), (1, None), (2, []), (3, [0.0, -0.0]), (10, [nan, 1.0]), (4, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (15, [1.0, 2.0, 3.0]), (8, [-0.0, 1.0]), (9, [0.0, 1.0]), (None, [1.0, 1.0])]
    got = found(table(rows, "vec_id long, embedding array<double>"), 20)
    unique = [r for n, r in enumerate(rows) if n != 8]
    assert got == {i: near for i, near in brute(unique, 20, lambda i: i % 5 == 0).items() if near}


def test_hungry_queries_search_everything(table, monkeypatch):
    monkeypatch.setattr(nearest, "fitted", lambda *_: nearest.Probe(1, 1, 0.9))
    rows = [(i, v.tolist()) for i, v in enumerate(clusters(60, 16, 5))]
    got = found(table(rows, "vec_id long, embedding array<float>"), 20)
    assert {i: [j for j, _ in n] for i, n in got.items()} == {i: [j for j, _ in n] for i, n in brute(rows, 20, lambda i: i % 5 == 0).items()}


def test_empty_table(table):
    assert found(table([], "vec_id long, embedding array<float>"), 3) == {}
