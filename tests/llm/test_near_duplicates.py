import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import near_duplicates
from ledgerloom.llm.components import components


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, percent):
    """(n, smallest reachable id) by row, comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            common = len(a & b)
            if a and b and 100 * common >= percent * (len(a) + len(b) - common):
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for (doc, _), g in zip(rows, group, strict=True):
        least[g] = min(least.get(g, doc), doc)
    return {doc: (len(s), least[g]) for (doc, _), s, g in zip(rows, sets, group, strict=True)}


def edited(text, share, seed):
    draw = random.Random(seed)
    return " ".join(f"new{draw.random()}" if draw.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def corpus(prose, long_text):
    rows = [(i, prose(random.Random(i).randint(1, 120), i)) for i in range(60)]
    rows += [(100 + i, edited(rows[40 + i % 5][1], 0.01 * (i % 9), i)) for i in range(60)]
    base = prose(80, 1000)
    rows += [(300 + i, edited(base, 0.04, 500 + i)) for i in range(50)]
    rows += [(400 + i, base) for i in range(30)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "one"), (504, "ONE"), (505, "one two"), (506, long_text), (507, long_text + " x")]
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_groups_equal_brute_force(docs, corpus, size):
    found = near_duplicates.report(docs(corpus), size=size, percent=80).collect()
    want = brute(corpus, size, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_one_row_of_each_group_stays(docs, corpus):
    rows = [*corpus, (3, corpus[3][1]), (None, "a text without an id is like no other text at all"), (None, "")]
    frame = docs(rows)
    kept = near_duplicates.keep_one(frame)
    assert kept.columns == frame.columns
    want = brute(corpus, 5, 80)
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    wordless = [None, 500, 501, 502]
    assert ids == sorted([None, *wordless, *(i for i, (n, least) in want.items() if n and i == least)], key=repr)


def test_rows_of_one_id_and_no_id(docs):
    rows = [(1, "a b c d"), (1, "e f g h"), (2, "A B C D"), (3, "e f g h"), (None, "i j k"), (None, "i j k"), (7, "i j k")]
    found = near_duplicates.report(docs(rows), size=2).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in found), key=repr) == sorted(
        [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (None, 7, False), (None, 7, False), (7, 7, True)], key=repr
    )


def test_empty_table(docs):
    assert near_duplicates.report(docs([])).count() == 0
    assert near_duplicates.keep_one(docs([])).count() == 0


def test_signature_distance_and_buckets(spark):
    """The lane arithmetic agrees with a symbol-wise count, and near pairs share a bucket."""
    draw = random.Random(4)
    rows = []
    for i in range(200):
        a = [[draw.randrange(2048) for _ in range(5)] for _ in range(8)]
        b = [list(c) for c in a]
        for place in draw.sample(range(40), near_duplicates.GUARANTEED if i % 2 else draw.randint(0, 40)):
            b[place // 5][place % 5] = draw.randrange(2048)
        pack = lambda s: [sum(v << (12 * j) for j, v in enumerate(c)) for c in s]
        apart = sum(x != y for c, d in zip(a, b, strict=True) for x, y in zip(c, d, strict=True))
        rows += [(2 * i, 1, *pack(a), apart), (2 * i + 1, 1, *pack(b), apart)]
    frame = spark.createDataFrame(rows, ["node", "n", *near_duplicates._CHUNK_NAMES, "apart"])
    pairs = frame.alias("x").join(frame.alias("y"), F.expr("x.node + 1 = y.node and x.node % 2 = 0"))
    apart = {r.node: (r.apart, r.d) for r in pairs.select("x.node", "x.apart", near_duplicates._distance("x", "y").alias("d")).collect()}
    assert all(want == got for want, got in apart.values())
    chunk = F.get(F.array(*near_duplicates._CHUNK_NAMES), F.floor(F.col("cell") / 5).cast("int"))
    sides = near_duplicates._entries(frame).join(frame, "node").withColumn("own", chunk)
    met = sides.alias("x").join(sides.alias("y"), F.expr("x.key = y.key and x.node + 1 = y.node and x.node % 2 = 0"))
    shared = {r.node for r in met.select("x.node").collect()}
    taken = [r.node for r in met.where(near_duplicates._taken_here("x", "y")).select("x.node").collect()]
    # Taken up once each, and all within the guaranteed distance.
    assert sorted(taken) == sorted(shared)
    assert all(node in shared or d > near_duplicates.GUARANTEED for node, (d, _) in apart.items())


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(20)] + [(200, 200), (7, 8), (8, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, **{100 + i: 100 for i in range(1, 20)}}
