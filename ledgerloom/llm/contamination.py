"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of the benchmark items. A document is
streamed through it word by word; the state tells the longest run that ends at the
word and occurs in some item. Where that run has ``window`` words or more, its last
``window`` words are a hit; an item of fewer words is a hit where it occurs whole.

A benchmark of many words is cut into pieces: items into runs of words that overlap by a window
less one word, which have the same windows, and the runs by a hash. An automaton is built and
broadcast for one piece after the other, so the broadcast is bounded whatever the size of the
benchmark or of an item. Every piece reads the texts once; only the hits are stored, by a hash of
128 bits of the text, and joined to the documents at the end.

Defined results: null and empty texts have no words and no hits; items without words
match nothing; an item id that is null counts as the empty text; repeated items
and repeated documents stay; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import batched, cut, free_name, rows_of

WINDOW = 10
PIECE_WORDS = 400_000
# Bytes that separate words are all of ASCII but digits and letters.
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _KEPT else 32 for b in range(256))
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


class Automaton:
    """Suffix automaton of many word sequences, with what a scan needs of each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.vocabulary = window, {}
        self.next, self.link, self.length = [{}], [0], [0]
        coded = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in text]) for name, text in items]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = self._extend(last, code)
        self._mark(coded)

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, parent: int, code: int, old: int) -> int:
        new = self._state(self.length[parent] + 1)
        self.next[new], self.link[new] = dict(self.next[old]), self.link[old]
        self.link[old] = new
        while self.next[parent].get(code) == old:
            self.next[parent][code] = new
            if parent == 0:
                break
            parent = self.link[parent]
        return new

    def _extend(self, last: int, code: int) -> int:
        if code in self.next[last]:
            there = self.next[last][code]
            return there if self.length[there] == self.length[last] + 1 else self._clone(last, code, there)
        new, parent = self._state(self.length[last] + 1), last
        while code not in self.next[parent]:
            self.next[parent][code] = new
            if parent == 0:
                return new
            parent = self.link[parent]
        there = self.next[parent][code]
        whole = self.length[there] == self.length[parent] + 1
        self.link[new] = there if whole else self._clone(parent, code, there)
        return new

    def _mark(self, coded: list[tuple[str, list[int]]]) -> None:
        """``items``: names at states of window length; ``short``: (length, name) of
        whole short items at their states; ``up``: the window state of each state;
        ``below``: the nearest proper suffix state that holds a short item."""
        count = len(self.next)
        self.items: list[set[str]] = [set() for _ in range(count)]
        self.short: list[list[tuple[int, str]]] = [[] for _ in range(count)]
        self.up = [-1] * count
        for state in sorted(range(1, count), key=self.length.__getitem__):
            if self.length[state] >= self.window:
                short = self.length[self.link[state]] < self.window
                self.up[state] = state if short else self.up[self.link[state]]
        for name, codes in coded:
            state = 0
            for code in codes:
                state = self.next[state][code]
                if self.up[state] >= 0:
                    self.items[self.up[state]].add(name)
            if 0 < len(codes) < self.window:
                self.short[state].append((len(codes), name))
        self.below = [0] * count
        for state in sorted(range(1, count), key=self.length.__getitem__):
            link = self.link[state]
            self.below[state] = link if self.short[link] else self.below[link]

    def scan(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit runs of words as merged (start, end), and the items that occur."""
        hits: list[tuple[int, int]] = []
        found: set[str] = set()
        following, link, length, up, window = self.next, self.link, self.length, self.up, self.window
        short, below, items = self.short, self.below, self.items
        state = run = 0
        for place, code in enumerate(map(self.vocabulary.get, text), 1):
            if code is None:
                state = run = 0
                continue
            onward = following[state].get(code)
            while onward is None and state:
                state = link[state]
                run = length[state]
                onward = following[state].get(code)
            state, run = onward, run + 1
            if run >= window:
                hits.append((place - window, place))
                found |= items[up[state]]
            if short[state] or below[state]:
                for size, name in short[state]:
                    if run >= size:
                        hits.append((place - size, place))
                        found.add(name)
                lower = below[state]
                while lower:
                    for size, name in short[lower]:
                        hits.append((place - size, place))
                        found.add(name)
                    lower = below[lower]
        return merged(hits), found


def merged(runs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching runs as one."""
    out: list[list[int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


_RUNS = T.ArrayType(T.ArrayType(T.LongType()))
_WORDS = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


def _runs(tests: DataFrame, window: int, longest: int) -> DataFrame:
    """(item, nth, text): the items in runs of ``longest`` words that have all their windows."""
    kind = pa.schema([("item", pa.string()), ("nth", pa.int64()), ("text", pa.string())])

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for item, text in rows_of(batches, "item", "text"):
                own = words(text)
                for at in range(0, max(1, len(own) - window + 1), longest - window + 1):
                    yield item, at, b" ".join(own[at : at + longest]).decode()

        yield from batched(out(), kind)

    return tests.mapInArrow(cut_up, "item string, nth long, text string")


def find(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, piece_words: int = PIECE_WORDS,
) -> DataFrame:
    """``docs`` with a last column of n_words, hits (merged runs of words) and items."""
    spark, name = docs.sparkSession, free_name(docs, "found")
    tests = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).cast("string").alias("text")
    )
    # A word takes a byte and a separator at least.
    size = tests.agg(F.sum(F.octet_length("text") + F.lit(1))).first()[0] or 0
    pieces = max(1, -(-size // (2 * piece_words)))
    if pieces > 1:
        return _in_pieces(docs, _runs(tests, window, max(2 * window, piece_words // 8)), pieces, name, text_col, window)
    kind = T.StructType(
        [T.StructField("n_words", T.LongType()), T.StructField("hits", _RUNS), T.StructField("items", T.ArrayType(T.StringType()))]
    )
    machine = spark.sparkContext.broadcast(Automaton([(r.item, words(r.text)) for r in tests.collect()], window))
    return docs.mapInArrow(_scanner(machine, text_col, name), T.StructType([*docs.schema.fields, T.StructField(name, kind)]))


def _in_pieces(docs: DataFrame, runs: DataFrame, pieces: int, name: str, text_col: str, window: int) -> DataFrame:
    spark, text = docs.sparkSession, F.col(text_col).cast("string")
    runs, tags = cut(runs), (F.xxhash64(text), F.xxhash64(text, F.lit(1)))
    slim, hits = docs.select(tags[0].alias("a"), tags[1].alias("b"), text.alias("text")), []
    for piece in range(pieces):
        own = runs.where(F.pmod(F.xxhash64("item", "nth"), F.lit(pieces)) == piece)
        machine = spark.sparkContext.broadcast(Automaton([(r.item, words(r.text)) for r in own.collect()], window))
        hits.append(cut(slim.mapInArrow(_hit_rows(machine), "a long, b long, hits array<array<long>>, items array<string>")))
        machine.destroy()
    found = reduce(DataFrame.unionAll, hits).groupBy("a", "b").agg(
        F.flatten(F.collect_set("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("hits", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(((a, b, merged(map(tuple, runs)), items) for a, b, runs, items in rows_of(batches, *kind.names)), kind)

    found = found.mapInArrow(join_up, "a long, b long, hits array<array<long>>, items array<string>")
    a, b, hit, item = (free_name(docs, c) for c in ("a", "b", "hits", "items"))
    tagged = docs.withColumns({a: tags[0], b: tags[1]}).join(found.toDF(a, b, hit, item), [a, b], "left")
    told = F.struct(
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORDS)).cast("long").alias("n_words"),
        F.coalesce(hit, F.array().cast(_RUNS)).alias("hits"),
        F.coalesce(item, F.array().cast("array<string>")).alias("items"),
    )
    return tagged.select(*docs.columns, told.alias(name))


def _hit_rows(machine):
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("hits", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for a, b, text in rows_of(batches, "a", "b", "text"):
                hits, items = machine.value.scan(words(text))
                if hits:
                    yield a, b, hits, sorted(items)

        yield from batched(out(), kind)

    return scan


def _scanner(machine, text_col: str, name: str):
    kind = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = machine.value
        for batch in batches:
            found = []
            for text in map(words, batch.column(text_col).to_pylist()):
                hits, items = automaton.scan(text)
                found.append({"n_words": len(text), "hits": hits, "items": sorted(items)})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, name])

    return scan


def _hit_words(found: str) -> Column:
    return F.aggregate(f"{found}.hits", F.lit(0).cast("long"), lambda n, run: n + run[1] - run[0])


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row for each document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = find(rows, benchmark, **options)
    of = found.columns[-1]
    return found.select(
        "doc_id",
        f"{of}.n_words",
        _hit_words(of).alias("n_hit"),
        F.size(f"{of}.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", f"{of}.items"), 256).alias("items_sha256"),
        (F.size(f"{of}.hits") > 0).alias("contaminated"),
    )


def clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", max_run: int = 0, max_coverage: float = 0.0, **options
) -> DataFrame:
    """Documents without benchmark text. A document whose share of hit words is over
    ``max_coverage`` goes; from the others, hit runs of more than ``max_run`` words are
    cut out of the text. At 0 every document with a hit goes."""
    found = find(docs, benchmark, text_col=text_col, **options)
    of = found.columns[-1]
    share = _hit_words(of) / F.greatest(F.col(f"{of}.n_words"), F.lit(1))
    kept = found.where(share <= max_coverage)
    if max_coverage <= 0:
        return kept.drop(of)  # no hit is left to cut out
    return kept.withColumn(text_col, _without_runs(F.col(text_col), F.col(f"{of}.hits"), F.lit(max_run))).drop(of)


@F.udf(T.StringType(), useArrow=True)
def _without_runs(text: str | None, runs: list[list[int]], longest: int) -> str | None:
    drop = [run for run in runs if run[1] - run[0] > longest]
    if not drop:
        return text
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for start, end in drop:
        out.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "".join([*out, text[at:]])


def digest(items: list[str]) -> str:
    """What ``items_sha256`` is, for tests."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
