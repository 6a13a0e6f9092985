import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import spelling


def brute_counts(rows):
    sums = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            sums[run] += 1
    return {w: n for w, n in sums.items() if len(w) >= 5 and n >= 3}


def edits(word, letters):
    out = {word[:i] + x + word[i:] for i in range(len(word) + 1) for x in letters}
    out |= {word[:i] + x + word[i + 1 :] for i in range(len(word)) for x in [*letters, ""]}
    return out - {word}


def brute_variants(counts):
    letters = {c for w in counts for c in w}
    out, forms = {}, {}
    for word, n in counts.items():
        near = [w for w in edits(word, letters) if w in counts]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best is not None and counts[best] >= 2 * n else None
        out[word] = len(near)
    rows = []
    for word, n in counts.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        form = forms[word]
        rows.append((word, form, root, n, out[word], counts[form] if form else None))
    return sorted(rows)


def typo(word, draw):
    at = draw.randrange(len(word))
    put = draw.choice(["", "x", "é", word[at] + "z"])
    return word[:at] + put + word[at + 1 :]


@pytest.fixture(scope="module")
def corpus(prose, long_text):
    draw = random.Random(1)
    base = ["liberty", "Häuser", "straße", "mountain", "river", "rivers", "driver", "drivers", "Letter", "better", "×wert÷", "fünfter"]
    rows = []
    for i in range(150):
        words = [draw.choice(base) for _ in range(30)]
        words = [typo(w, draw) if draw.random() < 0.3 else w for w in words]
        rows.append((i, draw.choice([" ", "-", "4", "\n"]).join(words)))
    rows += [(200 + i, prose(300, i % 5)) for i in range(20)]
    rows += [(300, None), (301, ""), (302, "123 ?"), (303, long_text), (303, long_text), (None, long_text), (None, "LIBERTY liberty LiBerty")]
    rows += [(400 + i, "a" * 5000 + "b" * (i % 2)) for i in range(8)]
    rows += [(500 + i, " ".join(["wander"] * 20 + ["wandern"] * 8 + ["wandernd"] * 3)) for i in range(4)]
    return rows


def test_counts_equal_brute_force(docs, corpus):
    found = {r.word: r.n for r in spelling.word_counts(docs(corpus)).collect() if r.n >= 3}
    assert found == brute_counts(corpus)


def test_report_equals_brute_force(docs, corpus):
    found = sorted(tuple(r) for r in spelling.report(docs(corpus)).collect())
    want = brute_variants(brute_counts(corpus))
    assert found == want
    assert any(r[1] for r in want) and any(r[2] != r[1] and r[1] for r in want)


def test_subtries_in_parts_and_turns(spark, docs, monkeypatch):
    """Random words of few letters: every word has many near ones."""
    monkeypatch.setattr(spelling, "PART", 30)
    monkeypatch.setattr(spelling, "TURN", 50)
    draw = random.Random(2)
    counts = {"".join(draw.choice("abcdé") for _ in range(draw.randint(5, 7))): draw.randint(3, 60) for _ in range(3000)}
    found = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert sorted(tuple(r) for r in found.collect()) == brute_variants(counts)


def test_leaves_of_very_many_anagrams():
    """All orders of few letters lie in few leaves; edits of one group ('a' and 'á') do, too."""
    draw = random.Random(4)
    words = {"".join(draw.choice("aaáábbc") for _ in range(8)) for _ in range(4000)}
    listed, asking = list(words), sorted(words)[:300] + ["aaáábbcc", "abc", "zzzzz"]
    near = [(asking[i], listed[j]) for i, j in spelling.Trie(listed).near(asking)]
    assert len(near) == len(set(near))
    assert set(near) == {(a, b) for a in asking for b in edits(a, "aábc") & words}


def test_each_pair_is_asked_once():
    for word in ("abcde", "zzzzz", "häuser"):
        for other in edits(word, "abzé"):
            a, b = spelling.subtrie(word), spelling.subtrie(other)
            assert a == b or (b in set(spelling.reachable(a))) != (a in set(spelling.reachable(b)))
    assert len(list(spelling.reachable((3,) * spelling.TOP))) == len(set(spelling.reachable((3,) * spelling.TOP)))


def test_one_apart():
    for a in ("abc", "abca", "é"):
        for b in edits(a, "abcé"):
            assert spelling.one_apart(a, b) and spelling.one_apart(b, a)
    words = ["a" * 31, "a" * 32, "a" * 31 + "b", "b" + "a" * 31, "abc", "abca", "abcé", "ab", "bc", "acb", "ba", "a", ""]
    for a in words:
        for b in words:
            if abs(len(a) - len(b)) <= 1:
                many = spelling.all_one_apart(spelling.spelled([a]), spelling.spelled([b]), np.array([len(b) - len(a)]))
                assert many[0] == spelling.one_apart(a, b) == (b in edits(a, "abcé")), (a, b)
    assert not any(spelling.one_apart(a, b) for a, b in [("abc", "abc"), ("abc", "acb"), ("abc", "abcde"), ("ab", "ba"), ("abcd", "bcde")])


def test_empty_tables(docs):
    assert spelling.report(docs([])).collect() == []
    assert spelling.report(docs([(1, None), (2, "few words here")])).collect() == []
