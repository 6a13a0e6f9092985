from collections import Counter

import pytest

from ledgerloom.llm import mixing


@pytest.mark.parametrize("counts", [{"a": 1}, {"a": 7, "b": 2, "c": 1}, {"a": 333, "b": 333, "c": 334}, {"a": 997, "b": 1, "c": 1, None: 1}])
def test_every_prefix_is_less_than_a_block_off(counts):
    turns, period, done = mixing.one_period(counts), sum(counts.values()), Counter()
    assert [s for _, _, s in turns] == list(range(period))
    for slot, (name, block, _) in enumerate(turns, 1):
        assert block == done[name]
        done[name] += 1
        assert all(abs(done[k] - slot * n / period) < 1 for k, n in counts.items())


def test_weights_are_rounded_to_the_period():
    assert mixing.whole_weights({"a": 0.5, "b": 0.3, "c": 0.2}, 30) == {"a": 15, "b": 9, "c": 6}
    found = mixing.whole_weights({"a": 1e9, "b": 1, None: 1}, 40)
    assert sum(found.values()) == 40 and min(found.values()) == 1
    for bad in ({}, {"a": 0}, {"a": float("nan")}):
        with pytest.raises(ValueError):
            mixing.whole_weights(bad, 10)


def corpus():
    rows = [(i, f"t{i}", None, "big") for i in range(500)]
    rows += [(1000 + i, "same", None, "small") for i in range(33)]
    return rows + [(2000 + i, None, None, None) for i in range(5)] + [(1, "t1", None, "big"), (None, "", None, "big")]


def test_mix_follows_the_schedule(docs):
    rows = corpus()
    mixed = mixing.mix(docs(rows), {"big": 6, "small": 3, None: 1}, block_rows=8, period=10, out=("at", "nth", "turn"))
    found = mixed.select("doc_id", "source", "at", "nth", "turn").collect()
    # Every row once at least, and no place twice.
    assert Counter((r.doc_id, r.source) for r in found if r.turn == 0) == Counter((r[0], r[3]) for r in rows)
    assert len({(r["at"], r.nth) for r in found}) == len(found)
    sources = {r["at"]: r.source for r in found}
    assert sorted(sources) == list(range(len(sources)))
    done = Counter()
    for slot in range(len(sources)):
        done[sources[slot]] += 1
        for name, weight in (("big", 0.6), ("small", 0.3), (None, 0.1)):
            assert abs(done[name] - (slot + 1) * weight) < 1
    # The source that takes longest comes in once, others start again.
    assert max(r.turn for r in found if r.source == "big") == 0
    assert max(r.turn for r in found if r.source == "small") > 0
    again = mixing.mix(docs(rows).repartition(7), {"big": 6, "small": 3, None: 1}, block_rows=8, period=10, out=("at", "nth", "turn"))
    key = lambda r: (r["at"], r.nth, r.doc_id, r.turn)
    assert sorted(map(key, again.collect()), key=repr) == sorted(map(key, found), key=repr)


def test_default_weights_favour_small_sources(docs):
    frame = docs(corpus())
    found = mixing.mix(frame, block_rows=4, out=("at", "nth", "turn"))
    assert found.columns == [*frame.columns, "at", "nth", "turn"]
    rows = Counter(r.source for r in found.collect())
    assert rows["big"] == 502 and rows["small"] > 33 and rows[None] > 5


def test_empty_table_and_lacking_weight(docs):
    assert mixing.mix(docs([]), out=("at", "nth", "turn")).count() == 0
    with pytest.raises(ValueError, match="small"):
        mixing.mix(docs(corpus()), {"big": 1, None: 1})


@pytest.mark.parametrize("weights", [{"a": 1 / 3, "b": 2 / 3 - 1e-5, "c": 1e-5}, {"hot": 250_000**0.7, **{i: 25_000**0.7 for i in range(20)}}])
def test_no_drift_from_unrounded_weights(weights):
    whole = list(mixing.exact_weights(weights).values())
    total, done = sum(whole), [0] * len(whole)
    for slot, (at, block) in zip(range(1, 300_001), mixing.turns(whole)):
        assert block == done[at]
        done[at] += 1
        if slot % 1000 < 3:
            assert all(abs(n * total - slot * w) < total for n, w in zip(done, whole, strict=True))


def test_mix_keeps_to_weights_that_no_period_holds(docs):
    weights = {"big": 1 - 1 / 3000, "small": 1 / 3000}
    rows = [(i, "x", None, "big") for i in range(4000)] + [(5000, "y", None, "small")]
    found = mixing.mix(docs(rows), weights, block_rows=1, out=("at", "nth", "turn")).collect()
    assert {r.doc_id for r in found} == {r[0] for r in rows}
    done = 0
    for slot, r in enumerate(sorted(found, key=lambda r: r["at"]), 1):
        assert r["at"] == slot - 1
        done += r.source == "small"
        assert abs(done - slot * weights["small"]) < 1


def test_many_sources(docs):
    rows = [(i, "x", None, f"s{i}") for i in range(10_050)]
    found = mixing.mix(docs(rows), out=("at", "nth", "turn")).select("doc_id", "at").collect()
    assert sorted(r["at"] for r in found) == list(range(len(rows))) and len({r.doc_id for r in found}) == len(rows)
