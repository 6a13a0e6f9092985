import random
import re

import pytest

from ledgerloom.llm import contamination


def split(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute(rows, items, window):
    windows = {}
    for name, text in items:
        own = split(text)
        name = "" if name is None else str(name)
        runs = [tuple(own[i : i + window]) for i in range(len(own) - window + 1)] if len(own) >= window else [tuple(own)] if own else []
        for run in runs:
            windows.setdefault(run, set()).add(name)
    out = []
    for doc, text in rows:
        own, hit, found = split(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                if names := windows.get(tuple(own[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= names
        out.append((doc, len(own), len(hit), len(found), contamination.digest(list(found)), bool(hit)))
    return sorted(out, key=repr)


def drawn(draw, words, letters):
    return " ".join(draw.choice(letters) for _ in range(words))


@pytest.mark.parametrize(("window", "letters"), [(10, "ab"), (4, "abcd"), (3, "abcdefgh")])
def test_automaton_equals_brute_force(window, letters):
    draw = random.Random(window)
    for _ in range(30):
        items = [(str(i), drawn(draw, draw.randint(0, 16), letters)) for i in range(8)]
        rows = [(i, drawn(draw, draw.randint(0, 60), letters + "z")) for i in range(10)]
        machine = contamination.Automaton([(n, contamination.words(t)) for n, t in items], window)
        got = []
        for doc, text in rows:
            own = contamination.words(text)
            hits, found = machine.scan(own)
            got.append((doc, len(own), sum(b - a for a, b in hits), len(found), contamination.digest(list(found)), bool(hits)))
        assert sorted(got, key=repr) == brute(rows, items, window)


ITEMS = [(1, "The quick brown fox, jumps over the lazy dog again today!"), (2, "short item"), (None, "one two three"), (4, None), (5, "..."), (6, "Éa ßb"), (2, "short item")]


def corpus(long_text):
    return [
        (1, "So THE quick-brown fox jumps over the lazy dog again; yes"),
        (2, "a Short\nitem here and one two three there"),
        (3, None),
        (4, ""),
        (5, "the quick brown fox jumps over the lazy dog"),
        (6, "x Éa ßb y"),
        (6, "x Éa ßb y"),
        (None, "short item"),
        (8, long_text + " short item " + long_text),
    ]


@pytest.mark.parametrize("piece_words", [400_000, 10])
def test_report_equals_brute_force(spark, docs, long_text, piece_words):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = contamination.report(docs(corpus(long_text)), items, piece_words=piece_words)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(corpus(long_text), ITEMS, 10)


def test_one_item_longer_than_a_piece(spark, docs, prose):
    item = prose(900, 3, 60)
    parts = item.split()
    rows = [(i, " ".join([*prose(20, i, 60).split(), *parts[i * 17 : i * 17 + 5 + i], "end"])) for i in range(50)] + [(99, item), (100, item)]
    items = spark.createDataFrame([("long", item), ("short", "one two")], "item_id string, text string")
    found = contamination.report(docs(rows), items, piece_words=200)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, [("long", item), ("short", "one two")], 10)


def test_clean_cuts_or_drops(spark, docs, long_text):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    frame = docs(corpus(long_text))
    strict = contamination.clean(frame, items)
    assert strict.columns == frame.columns
    assert sorted(r.doc_id for r in strict.collect()) == [3, 4, 5]
    # Runs of over 2 words are cut out; documents more than half covered go.
    loose = {r.doc_id: r.text for r in contamination.clean(frame, items, max_run=2, max_coverage=0.7).collect()}
    assert loose[2] == "a Short\nitem here and  there"
    assert sorted(loose, key=repr) == sorted([2, 3, 4, 5, 6, 8], key=repr)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    found = contamination.report(docs([(1, "a b")]), none).collect()
    assert [tuple(r) for r in found] == [(1, 2, 0, 0, contamination.digest([]), False)]
    assert contamination.report(docs([]), none).count() == 0
