import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import repeats, suffix_array

N = repeats.LENGTH


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + N] for t in texts for i in range(len(t) - N + 1))
    out = []
    for (doc, _), text in zip(rows, texts, strict=True):
        hit = bytearray(len(text))
        for i in range(len(text) - N + 1):
            if seen[text[i : i + N]] > 1:
                hit[i : i + N] = b"\1" * N
        runs = sum(1 for i, x in enumerate(hit) if x and (i == 0 or not hit[i - 1]))
        kept = bytes(c for c, x in zip(text, hit, strict=True) if not x)
        out.append((doc, len(text), sum(hit), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_equals_brute_force(docs, prose):
    draw = random.Random(8)
    passages = [prose(draw.randint(60, 220), 700 + i, 3000) for i in range(6)]
    rows = []
    for i in range(70):
        parts = [prose(draw.randint(0, 90), 5000 + i, 3000)]
        for _ in range(draw.randint(0, 3)):
            passage = draw.choice(passages)
            a = draw.randint(0, 200)
            parts += [passage[a : a + draw.choice([N - 1, N, N + 1, N + 37, 5000])], prose(draw.randint(0, 60), draw.random(), 3000)]
        rows.append((i, draw.choice([" ", ""]).join(parts)))
    exact = prose(90, 41, 3000)[: N]
    rows += [(100, "a" + exact + "b"), (101, "c" + exact + "d"), (102, exact[:-1]), (103, "x" + exact[:-1] + "!")]
    rows += [(110, "ab" * 400), (111, "z" * 1200), (112, "z" * N), (113, "z" * (N - 1)), (114, "-" + "z" * N)]
    rows += [(120, passages[0]), (120, passages[0]), (121, None), (122, ""), (123, "short"), (123, "short"), (None, passages[1] + "é" * 300), (None, "é" * 300)]
    found = repeats.report(docs(rows))
    assert sorted(map(tuple, found.drop("spans").collect()), key=repr) == brute(rows)


def test_many_near_copies(docs, prose):
    """Edits all over many copies: what is left of each is told exactly."""
    draw, base = random.Random(2), prose(500, 77, 3000)
    rows = []
    for i in range(60):
        at = draw.randrange(len(base))
        rows.append((i, base[:at] + f"[{i}]" + base[at + draw.randint(0, 30) :]))
    found = repeats.report(docs(rows))
    assert sorted(map(tuple, found.drop("spans").collect()), key=repr) == brute(rows)


def test_segments_do_not_change_the_anchors(prose, monkeypatch):
    data = (prose(4000, 5) + "q" * 3000 + prose(2000, 6)).encode()
    for run, window in ((repeats.RUN, repeats.WINDOW), (repeats.SAMPLE_RUN, repeats.SAMPLE_WINDOW)):
        monkeypatch.setattr(repeats, "SEGMENT", 1 << 20)
        whole = [part.tolist() for part in repeats.anchors(data, run, window)]
        monkeypatch.setattr(repeats, "SEGMENT", 1000)
        assert [part.tolist() for part in repeats.anchors(data, run, window)] == whole


def test_empty_table(docs):
    assert repeats.report(docs([])).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 100])
def test_suffixes_are_sorted(spark, n):
    draw = random.Random(n)
    text = [5] * (n // 3) + [draw.choice([5, 6]) for _ in range(n - 1 - n // 3)] + [-1]
    text = text[-n:]
    frame = spark.createDataFrame(list(enumerate(text)), "pos long, sym long")
    found = {r.pos: r["rank"] for r in suffix_array.suffix_ranks(frame, n, small=3, size=16).collect()}
    assert found == {p: i for i, p in enumerate(sorted(range(n), key=lambda p: text[p:]))}


@pytest.mark.parametrize("depth", [1, 3, 8, 40])
def test_a_bounded_depth_bounds_the_levels(spark, monkeypatch, depth):
    """Copies of one long passage differ only at their ends: the whole order takes seven levels."""
    draw = random.Random(depth)
    passage = [draw.choice([5, 6]) for _ in range(150)]
    text = [x for i in range(5) for x in [*passage, *[5] * 60, -i - 1]]
    levels, blocks = [], suffix_array._blocks
    monkeypatch.setattr(suffix_array, "_blocks", lambda *a: levels.append(1) or blocks(*a))
    frame = spark.createDataFrame(list(enumerate(text)), "pos long, sym long")
    found = suffix_array.suffix_ranks(frame, len(text), small=3, size=64, depth=depth).collect()
    order = [r.pos for r in sorted(found, key=lambda r: r["rank"])]
    assert sorted(r["rank"] for r in found) == list(range(len(text))) and sorted(order) == list(range(len(text)))
    heads = [text[p : p + depth] for p in order]
    assert heads == sorted(heads)
    assert 3 ** (len(levels) - 1) < max(depth, 2)


def test_anchors_of_many_texts_are_those_of_each(prose):
    texts = [(prose(70 + 9 * i, 50 + i) + "q" * (N + i)).encode() for i in range(40)] + [b"ab" * 40_000, prose(200, 3).encode()]
    for run, window in ((repeats.RUN, repeats.WINDOW), (repeats.SAMPLE_RUN, repeats.SAMPLE_WINDOW)):
        found = [[] for _ in texts]
        for own, places, hashes in repeats.anchors_of(texts, run, window):
            for text, *anchor in zip(own.tolist(), places.tolist(), hashes.tolist(), strict=True):
                found[text].append(tuple(anchor))
        assert found == [list(zip(*(x.tolist() for x in repeats.anchors(t, run, window)), strict=True)) for t in texts]


def test_suffixes_are_ranked_among_some(spark):
    text = [5, 6, 5, 6, 5, 6, 7, -1]
    frame = spark.createDataFrame(list(enumerate(text)), "pos long, sym long")
    some = spark.createDataFrame([(p,) for p in (0, 3, 4, 6)], "pos long")
    found = {r.pos: r["rank"] for r in suffix_array.suffix_ranks(frame, len(text), small=3, size=16, among=some).collect()}
    assert found == {p: i for i, p in enumerate(sorted((0, 3, 4, 6), key=lambda p: text[p:]))}


def test_periodic_texts_are_spelled_once(docs, prose):
    """Lines that repeat in a text are in the text of all symbols once; what is removed stays the same."""
    line = prose(14, 9, 3000) + "\n"
    rows = [(i, prose(30, 20 + i) + line * (12 + 5 * i) + prose(30, 60 + i)) for i in range(8)]
    rows += [(20 + i, "ab" * (900 + 9 * i) + prose(60, 90 + i)) for i in range(3)]
    texts = [t.encode() for _, t in rows]
    parts = [(np.full(len(p), i), p) for i, t in enumerate(texts) for p in [repeats.anchors(t)[0]]]
    text, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
    gaps = np.where(text[1:] == text[:-1], np.diff(pos), 0)
    context = np.array([hash(texts[t][max(0, p - repeats.LEFT) : p + repeats.RIGHT]) for t, p in zip(text.tolist(), pos.tolist(), strict=True)])
    own = repeats.Anchors(pos, np.append(0, gaps), np.append(gaps, 0), context, text)
    alike = own.alike()
    some, _, _ = own.spelled(alike)
    seen, fresh = set(), []
    for word in zip(text.tolist(), own.words(), strict=True):
        fresh.append(word not in seen)
        seen.add(word)
    assert [x != repeats.LATER for x in alike.tolist()] == fresh
    assert len(some) < len(pos) / 2
    found = repeats.report(docs(rows))
    assert sorted(map(tuple, found.drop("spans").collect()), key=repr) == brute(rows)
