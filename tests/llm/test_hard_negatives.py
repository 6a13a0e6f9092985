import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import hard_negatives

NAN, INF = float("nan"), float("inf")


def brute(rows, every=5, positives=5, negatives=3):
    """``rows`` of (id, label, vector), one for each id."""
    fine = [
        (i, label, [math.floor(256 * x) for x in vec])
        for i, label, vec in rows
        if None not in (i, label, vec) and all(x is not None and math.isfinite(x) and abs(256 * x) < 2**24 for x in vec)
    ]
    out = []
    for anchor, label, vec in fine:
        if anchor % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vec, v)), i, own) for i, own, v in fine if i != anchor and len(v) == len(vec))
        for score, pos, _ in [s for s in scored if s[2] == label][:positives]:
            hard = [(i, -s) for s, i, own in scored if own != label and 50 * -score <= 100 * -s <= 95 * -score]
            out += [(anchor, pos, nth, i, -score, s) for nth, (i, s) in enumerate(hard[:negatives], 1)]
    return sorted(out)


def mined(table, rows, every=5):
    rows = [(i, kind, vec and [x if x is None else float(x) for x in vec]) for i, kind, vec in rows]
    frame = table(rows, "vec_id long, kind int, embedding array<float>")
    return sorted(tuple(r) for r in hard_negatives.mine(frame, F.col("id") % every == 0, F.col("kind")).collect())


def vectors(count, size, seed, labels=4, scale=1.0):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(labels, size)) + 1.5
    kinds = draw.integers(0, labels, count)
    points = (middle[kinds] + 0.9 * draw.normal(size=(count, size))) * scale
    return [(i, int(k), [float(np.float32(x)) for x in p]) for i, (k, p) in enumerate(zip(kinds, points))]


@pytest.mark.parametrize("size", [1, 7, 8, 19])
def test_packed_scores_are_inner_products(size):
    draw = np.random.default_rng(size)
    for largest in (0, 1, 130, 9000, 2**24 - 1):
        anchors, rows = (draw.integers(-largest, largest + 1, (n, size)) for n in (6, 11))
        rows[0], anchors[0] = -largest, largest
        planes = hard_negatives.packed(rows, int(largest).bit_length() + 1)
        found = hard_negatives.Tables(anchors, largest).scores(planes)
        assert (found == rows @ anchors.T).all()


def test_rows_equal_brute_force(table):
    rows = vectors(400, 12, 1)
    found = mined(table, rows)
    assert found == brute(rows) and len(found) > 100


def test_blocks_do_not_change_rows(table, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", 30)
    monkeypatch.setattr(hard_negatives, "CHUNK", 5)
    rows = vectors(300, 5, 2)
    assert mined(table, rows) == brute(rows)


def test_ties_and_one_common_vector(table):
    """A third of the rows have one vector; scores tie across labels."""
    common = [0.5, 0.25, 0.125, 1.0]
    rows = vectors(200, 4, 3) + [(1000 + i, i % 3, common) for i in range(150)]
    rows += [(2000 + i, 9, [x * 0.7 for x in common]) for i in range(40)]
    rows += [(3000 + i, 3, [0.0] * 4) for i in range(6)]
    random.Random(1).shuffle(rows)
    assert mined(table, rows) == brute(rows)


def test_rows_that_take_no_part(table):
    rows = vectors(120, 6, 4)
    rows += [(500, None, rows[0][2]), (505, 1, None), (510, 1, [1.0, None, 0, 0, 0, 0]), (515, 1, [NAN] * 6), (520, 2, [1, 1, INF, 0, 0, 0])]
    rows += [(525, 2, [1e9, 0, 0, 0, 0, 0]), (None, 1, rows[1][2]), (530, 1, []), (535, 2, []), (540, 1, [1.0, 2.0]), (541, 1, [1.0, 2.0]), (542, 2, [1.0, 1.0])]
    fed = [*rows, rows[3], rows[3], rows[10], (rows[10][0], rows[10][1] + 1, rows[10][2])]
    assert mined(table, fed) == brute(rows)


def test_large_components(table):
    rows = vectors(80, 9, 5, scale=2000.0)
    assert mined(table, rows) == brute(rows)


def test_empty_tables(table):
    assert mined(table, []) == []
    assert mined(table, [(1, 1, [1.0]), (2, 2, [1.0])]) == []
    assert mined(table, [(5, 1, [1.0])]) == []
