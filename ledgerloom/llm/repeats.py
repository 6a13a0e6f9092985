"""Removal of long repeated byte strings by a suffix array.

A string of ``LENGTH`` bytes that occurs twice, in whatever documents, is removed wherever
it occurs. The suffix array is built over anchors rather than single bytes:

0. A sparse sample of runs of 128 bytes, one at least in every string, tells which texts can
   have a repeat at all. The steps below see those only.
1. Anchors are the minimizers of the text: the smallest hash among ``WINDOW`` successive
   16-byte runs. Which positions of a string are anchors depends on the string
   alone, but near its ends; any string of ``LENGTH`` bytes has an anchor whose
   surroundings of 270 bytes (its context) lie inside the string. So only anchors
   whose context occurs twice matter; the others are dropped after one grouped count.
2. An anchor's symbol is the hash of its context and the distance to the next
   anchor; runs of anchors that are left form the text, each ended by a symbol of its own.
   An anchor whose symbols, as far as they matter, are those of an earlier one of its document
   is known to repeat; the text has what the others need.
   The suffixes of that text are sorted by the difference cover (``suffix_array``), as deep
   as any anchor needs.
3. Adjacent suffixes are compared. Where an anchor's suffix has enough symbols in common
   with a neighbour, the strings around it are repeats. Strings that start within an
   anchor distance of the end of a match can't be told by anchors: their bytes are
   hashed and grouped, together with one member of each set of equal strings that
   the suffix array knows. What neighbouring strings have in common, their core, is
   hashed first; only strings whose core occurs twice are hashed themselves.

Equal texts are one text with a count. Contexts are told by 63-bit hashes, whole
strings by 95 bits.

Defined results: null and empty texts have no bytes and nothing is removed; a text of
less than ``LENGTH`` bytes keeps all; a repeated row is a copy, so both are
removed; document ids may be null or repeated; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, new_folder, remove, stored
from ledgerloom.llm.suffix_array import numbered, suffix_ranks, with_halo

LENGTH = 400
RUN, WINDOW = 16, 128
#: A context reaches so far before and after its anchor.
LEFT, RIGHT = WINDOW - 1, WINDOW + RUN - 1
#: The sparse sample that tells which texts matter: LENGTH is at least their sum less 1.
SAMPLE_RUN, SAMPLE_WINDOW = 128, 256
#: Long texts are cut into segments, and short ones are put together, of so many bytes.
SEGMENT = 1 << 16
#: So many neighbouring strings share a core; no string starts 16 times as far before its first anchor.
CHUNK = 16
#: Hashes of strings come in batches of so many.
HASHED = 1 << 17
_LOW = (1 << 63) - 1
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)


def _run_hashes(data: np.ndarray, run: int) -> np.ndarray:
    """A hash of the bytes from each position on, a power of 2 of them and 8 at least, by doubling."""
    raw = data.tobytes()
    hashes, width, factor = np.empty(len(raw) - 7, np.uint64), 8, _MIX[0]
    for at in range(8):
        hashes[at::8] = np.frombuffer(raw, "<u8", (len(raw) - at) // 8, at)
    while width < run:
        longer = hashes[:-width] * np.uint64(factor)
        longer += hashes[width:]
        hashes, width, factor = longer, 2 * width, factor * factor % (1 << 64)
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(_MIX[1])
    return hashes ^ (hashes >> np.uint64(29))


def _minimizers(data: np.ndarray, ends: np.ndarray, run: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that are the first smallest of some window, a power of 2, inside one of the texts
    that lie one behind the other and end at ``ends``; and their hashes. Several texts
    have a window each, at least."""
    span = run + window - 1
    if len(data) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = _run_hashes(data, run)
    # One mask for all lengths, so that equal windows have equal minima.
    low = np.uint64((1 << 32) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while width < window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    fresh = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    if len(ends) > 1:
        # The first window of a minimum is in one text, or a later one begins the next text.
        end, final = ends[np.searchsorted(ends, fresh, side="right")], np.append(fresh[1:], len(least)) - 1
        fresh = fresh[(fresh + span <= end) | (final >= end)]
    places = (least[fresh] & low).astype(np.int64)
    return places, (hashes[places] >> np.uint64(1)).astype(np.int64)


def anchors(data: bytes, run: int = RUN, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of a text, in order, and their hashes. Long texts are cut into segments
    that overlap."""
    if len(data) <= SEGMENT:
        return _minimizers(np.frombuffer(data, np.uint8), np.array([len(data)]), run, window)
    halo, found = window + run, []
    for at in range(0, len(data), SEGMENT):
        start = max(0, at - halo)
        part = np.frombuffer(data[start : at + SEGMENT + halo], np.uint8)
        places, hashes = _minimizers(part, np.array([len(part)]), run, window)
        own = (places + start >= at) & (places + start < at + SEGMENT)
        found.append((places[own] + start, hashes[own]))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def anchors_of(texts: list[bytes], run: int = RUN, window: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, position, hash) of the anchors of many texts, some texts at a time."""
    at = 0
    while at < len(texts):
        end, size = at + 1, len(texts[at])
        while end < len(texts) and size + len(texts[end]) <= SEGMENT:
            size += len(texts[end])
            end += 1
        if end == at + 1:
            places, hashes = anchors(texts[at], run, window)
            yield np.full(len(places), at), places, hashes
        else:
            ends = np.cumsum([len(t) for t in texts[at:end]])
            places, hashes = _minimizers(np.frombuffer(b"".join(texts[at:end]), np.uint8), ends, run, window)
            own = np.searchsorted(ends, places, side="right")
            yield own + at, places - np.concatenate(([0], ends))[own], hashes
        at = end


def _long_texts(batch: pa.RecordBatch) -> tuple[np.ndarray, list[bytes]]:
    """Keys and bytes of the texts that can have a repeat."""
    long = batch.filter(pc.greater_equal(pc.binary_length(batch.column("text")), LENGTH))
    return long.column("key").to_numpy(), long.column("text").cast(pa.binary()).to_pylist()


def _sampled(docs: DataFrame) -> DataFrame:
    """(key, pos, run): a sparse sample of long runs; every string has one in it. Of a run that a
    text has many times, the first and the last place: they tell that it repeats."""
    kind = pa.schema([(n, pa.int64()) for n in ("key", "pos", "run")])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = _long_texts(batch)
            for own, places, hashes in anchors_of(texts, SAMPLE_RUN, SAMPLE_WINDOW):
                order = np.lexsort((places, hashes, own))
                own, places, hashes = own[order], places[order], hashes[order]
                fresh = np.ones(len(own) + 1, bool)
                fresh[1:-1] = (own[1:] != own[:-1]) | (hashes[1:] != hashes[:-1])
                ends = fresh[:-1] | fresh[1:]
                own, places, hashes = own[ends], places[ends], hashes[ends]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (keys[own], places, hashes)], schema=kind)

    return docs.mapInArrow(find, "key long, pos long, run long")


def _repeated(found: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` occurs at another place, too. Copies of a text are one
    place. Places are combined before the shuffle; the table of repeated values is
    the smaller side and need not be sorted."""
    place = F.xxhash64("key", *(c for c in found.columns if c not in ("key", column)))
    twice = found.groupBy(column).agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select(column)
    return found.join(twice.hint("shuffle_hash"), column)


def _anchored(docs: DataFrame) -> DataFrame:
    """(key, spot, context): anchors with a whole context. A spot is the position and
    the distances to the anchors before and after it (0 for none; at most WINDOW)."""
    names = ["key", "spot", "context"]
    kind = pa.schema([(n, pa.int64()) for n in names])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = _long_texts(batch)
            sizes = np.array([len(t) for t in texts], np.int64)
            for text, places, _ in anchors_of(texts):
                gaps = np.where(text[1:] == text[:-1], np.diff(places), 0)
                gaps = np.concatenate(([0], gaps, [0])) if len(places) else np.zeros(1, np.int64)
                own = (places >= LEFT) & (places + RIGHT <= sizes[text])
                text, at = text[own], places[own]
                hashed = [xxhash.xxh3_64_intdigest(texts[t][p - LEFT : p + RIGHT]) >> 1 for t, p in zip(text.tolist(), at.tolist(), strict=True)]
                spot = (at << 16) | (gaps[:-1][own] << 8) | gaps[1:][own]
                yield pa.RecordBatch.from_arrays([pa.array(keys[text]), pa.array(spot), pa.array(hashed, pa.int64())], schema=kind)

    return docs.mapInArrow(find, ", ".join(f"{n} long" for n in names))


_ANCHOR_LISTS = ("pos", "before", "after", "context")
#: Anchors whose symbols no other of the text has, the first of several alike, and the later ones.
ALONE, FIRST, LATER = 0, 1, 2
_PREFIXES = ("at", "low", "high")


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, one behind the other, and the row of each."""
    lists = batch.column(name)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lists)), sizes)


def _listed(values: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """A column of lists; the values are in the order of their rows."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32()), pa.array(values, pa.int64()))


class Anchors:
    """The anchors of the texts of a batch, one text behind the other."""

    def __init__(self, pos: np.ndarray, before: np.ndarray, after: np.ndarray, context: np.ndarray, text: np.ndarray):
        self.pos, self.before, self.after, self.context, self.text = pos, before, after, context, text
        # Whether the next anchor is the successor in the same text.
        self.linked = np.zeros(len(pos), bool)
        self.linked[:-1] = (text[:-1] == text[1:]) & (pos[:-1] + after[:-1] == pos[1:]) & (after[:-1] > 0)
        # One past the run of anchors that each belongs to.
        ends = np.flatnonzero(~self.linked) + 1
        self.end = ends[np.searchsorted(ends, np.arange(len(pos)), side="right")] if len(pos) else ends
        self.first = np.searchsorted(text, text)

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Anchors:
        return cls(*(_flat(batch, c)[0] for c in _ANCHOR_LISTS), _flat(batch, "pos")[1])

    def index(self) -> np.ndarray:
        """The number of each anchor in its text."""
        return np.arange(len(self.pos)) - self.first

    def symbols(self) -> np.ndarray:
        mixed = (self.context.astype(np.uint64) ^ (self.after.astype(np.uint64) * np.uint64(_MIX[0]))) * np.uint64(_MIX[1])
        return ((mixed ^ (mixed >> np.uint64(32))) >> np.uint64(1)).astype(np.int64)

    def horizon(self) -> np.ndarray:
        """One past the last anchor whose symbol can matter to strings around each anchor."""
        place = self.text * (1 << 40) + self.pos
        return np.minimum(self.end, np.searchsorted(place, place + 2 * WINDOW + 1) + 1)

    def words(self) -> list[bytes]:
        """The symbols that matter to strings around each anchor."""
        text = self.symbols().tobytes()
        return [text[8 * i : 8 * end] for i, end in enumerate(self.horizon().tolist())]

    def alike(self) -> np.ndarray:
        """ALONE, FIRST or LATER for each anchor."""
        words = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words()], np.uint64)
        order = np.lexsort((words, self.text))
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = (words[order][1:] == words[order][:-1]) & (self.text[order][1:] == self.text[order][:-1])
        found = np.zeros(len(order), np.int64)
        found[order] = np.where(same[:-1], LATER, np.where(same[1:], FIRST, ALONE))
        return found

    def spelled(self, alike: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The anchors whose symbols are in the text of all symbols, where they are in what their own
        text adds to it, and whether an end symbol follows."""
        own = np.flatnonzero(alike != LATER)
        steps = np.zeros(len(self.pos) + 1, np.int64)
        np.add.at(steps, own, 1)
        np.add.at(steps, self.horizon()[own], -1)
        covered = np.cumsum(steps[:-1]) > 0
        some = np.flatnonzero(covered)
        ends = ~self.linked[some] | ~np.append(covered, False)[some + 1]
        at = np.arange(len(some)) + np.cumsum(ends) - ends
        return some, at - at[np.searchsorted(self.text[some], self.text[some])], ends


def _texts_of_anchors(kept: DataFrame) -> DataFrame:
    """A row for each text with lists of its anchors, the number of its symbols, where they
    start in the text of all symbols and how many symbols matter to one of them. The lists are bounded by the text."""
    lists = kept.groupBy("key").agg(F.collect_set(F.struct("spot", "context")).alias("anchors"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, rows = batch.column("anchors"), batch.num_rows
            text = np.repeat(np.arange(rows), pc.list_value_length(column).to_numpy())
            spot, context = (x.to_numpy() for x in column.flatten().flatten())
            order = np.lexsort((context, spot, text))
            spot, context = spot[order], context[order]
            own = Anchors(spot >> 16, spot >> 8 & 255, spot & 255, context, text)
            alike = own.alike()
            some, _, ends = own.spelled(alike)
            symbols = np.bincount(text[some], minlength=rows) + np.bincount(text[some[ends]], minlength=rows)
            depth = np.zeros(rows, np.int64)
            np.maximum.at(depth, text, own.horizon() - np.arange(len(text)))
            lists = [_listed(x, text, rows) for x in (*(getattr(own, c) for c in _ANCHOR_LISTS), alike)]
            columns = [batch.column("key"), *lists, pa.array(symbols, pa.int64()), pa.array(depth)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", *_ANCHOR_LISTS, "alike", "symbols", "depth"])

    schema = f"key long, {', '.join(f'{c} array<long>' for c in (*_ANCHOR_LISTS, 'alike'))}, symbols long, depth long"
    return cut(numbered(cut(lists.mapInArrow(unpack, schema)), "start", "symbols"))


def _symbol_rows(texts: DataFrame) -> DataFrame:
    """(pos, sym) of all texts. A run's end has a negative symbol, unlike all others."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = Anchors.of(batch)
            some, at, ended = own.spelled(_flat(batch, "alike")[0])
            place = batch.column("start").to_numpy()[own.text[some]] + at
            ends = place[ended] + 1
            at, sym = np.concatenate((place, ends)), np.concatenate((own.symbols()[some], -ends - 1))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sym)], names=["pos", "sym"])

    return texts.mapInArrow(spell, "pos long, sym long")


def _common_prefixes(texts: DataFrame, total: int, depth: int | None, folder: str) -> DataFrame:
    """(key, i, low, high): how many symbols anchor i of a text has in common with the
    suffix before and the suffix after it. Only where there are any."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, alike = Anchors.of(batch), _flat(batch, "alike")[0]
            some, at, _ = own.spelled(alike)
            good = alike[some] != LATER
            some, at = some[good], at[good]
            words, text = own.words(), own.text[some]
            columns = [batch.column("key").to_numpy()[text], own.index()[some], batch.column("start").to_numpy()[text] + at]
            words = pa.array([words[i] for i in some.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), words], names=["key", "i", "pos", "word"])

    own = stored(texts.mapInArrow(spread, "key long, i long, pos long, word binary"), f"{folder}/words")
    ranks = suffix_ranks(stored(_symbol_rows(texts), f"{folder}/symbols"), total, depth=depth, among=own.select("pos"))
    suffixes = own.join(ranks, "pos")
    in_blocks = suffixes.select("key", "i", "rank", "word", with_halo(F.col("rank"), 1).alias("block"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        words, rank = rows["word"].tolist(), rows["rank"].to_numpy()
        same = np.zeros(len(words), np.int64)
        for at in range(1, len(words)):
            a, b = words[at - 1], words[at]
            if a[:8] == b[:8] and rank[at - 1] + 1 == rank[at]:
                n = min(len(a), len(b))
                if a[:n] != b[:n]:
                    n = next(j for j in range(8, n, 8) if a[j : j + 8] != b[j : j + 8])
                same[at] = n // 8
        key, i, some = rows["key"].to_numpy(), rows["i"].to_numpy(), np.flatnonzero(same)
        low = pd.DataFrame({"key": key[some], "i": i[some], "low": same[some], "high": 0})
        high = pd.DataFrame({"key": key[some - 1], "i": i[some - 1], "low": 0, "high": same[some]})
        return pd.concat([low, high])

    pairs = in_blocks.groupBy("block").applyInPandas(compare, "key long, i long, low long, high long")
    return pairs.groupBy("key", "i").agg(F.max("low").alias("low"), F.max("high").alias("high"))


class Starts(Anchors):
    """What the anchors of texts say about each start of a string of LENGTH bytes. Ranges of
    starts are arrays of their anchors, first and last starts."""

    def __init__(self, sizes: np.ndarray, anchors: tuple, alike: np.ndarray, at: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray):
        super().__init__(*anchors)
        # Anchors alike have all their symbols in common, and the first stands for the others.
        symbols = self.horizon() - np.arange(len(self.pos))
        self.low, self.high = np.where(alike == LATER, symbols, 0), np.where(alike != ALONE, symbols, 0)
        known = np.searchsorted(self.text, of) + at
        self.low[known], self.high[known] = low, np.maximum(np.maximum(low, high), self.high[known])
        self.last = sizes[self.text] - LENGTH

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Starts:
        anchors = (*(_flat(batch, c)[0] for c in _ANCHOR_LISTS), _flat(batch, "pos")[1])
        at, row = _flat(batch, "at")
        low, high = (_flat(batch, c)[0] for c in ("low", "high"))
        return cls(batch.column("n_bytes").to_numpy(), anchors, _flat(batch, "alike")[0], at, row, low, high)

    def _reach(self, symbols: np.ndarray) -> np.ndarray:
        """The last start whose string is inside the contexts of so many anchors from each on."""
        final = self.pos[np.arange(len(self.pos)) + np.maximum(symbols, 1) - 1]
        return np.where(symbols > 0, final + RIGHT - LENGTH, -1)

    def repeats(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranges of starts whose strings are repeats, by the suffix array. An anchor decides
        the starts from the first of its context up to that of the next anchor."""
        first = self.pos - LEFT
        last = np.where(self.after > 0, first + self.after - 1, first)
        last = np.minimum(np.minimum(last, self._reach(self.high)), self.last)
        some = np.flatnonzero(first <= last)
        return some, first[some], last[some]

    def open(self) -> tuple[tuple, tuple]:
        """Of the strings whose first inner anchor is each one: starts that may be repeats but
        are not known to be, and known ones that no smaller suffix stands for."""
        count = len(self.pos)
        final = self.pos - LEFT
        first = np.where(self.before > 0, np.maximum(0, final - self.before + 1), 0)
        # All anchors up to the string's last inner one must be in the run, and match.
        match, tail = np.arange(count) + self.high, self.end - 1
        bar = np.where(self.after[tail] > 0, self.pos[tail] + self.after[tail], 1 << 40)
        bar = np.where(match + 1 < self.end, self.pos[np.minimum(match + 1, count - 1)], bar)
        may = np.minimum(np.minimum(final, self.last), bar - 1 - (LENGTH - RIGHT))
        # The last start is decided by the anchor itself, those before by the one before it.
        known, follows = first - 1, first - 1
        high, low = self._reach(self.high), self._reach(self.low)
        inner = np.minimum(final - 1, self.last)[1:]
        linked = self.linked[:-1]
        known[1:] = np.where(linked, np.maximum(known[1:], np.minimum(inner, high[:-1])), known[1:])
        follows[1:] = np.where(linked, np.maximum(follows[1:], np.minimum(inner, low[:-1])), follows[1:])
        own = (first <= final) & (final <= self.last)
        ends = own & (high < final) & (final <= may)
        stands = own & (high >= final) & (low < final)

        def ranges(a: np.ndarray, b: np.ndarray, single: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            some, lone = np.flatnonzero(a <= b), np.flatnonzero(single)
            return np.concatenate((some, lone)), np.concatenate((a[some], final[lone])), np.concatenate((b[some], final[lone]))

        return ranges(known + 1, np.minimum(may, final - 1), ends), ranges(follows + 1, known, stands)


    def chunk(self, i: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The chunk of a start whose first inner anchor is i: strings that are equal have equal ones."""
        return i * CHUNK + (self.pos[i] - start) // CHUNK

    def chunks(self, i: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        a, b = self.chunk(i, last), self.chunk(i, first)
        count = b - a + 1
        return np.unique(np.repeat(b - np.cumsum(count) + 1, count) + np.arange(count.sum()))

    @staticmethod
    def expanded(i: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each start of the ranges and its anchor, about HASHED at a time."""
        ends = np.cumsum(last - first + 1)
        for part in np.split(np.arange(len(i)), np.flatnonzero(np.diff(ends // HASHED)) + 1):
            size = (last - first + 1)[part]
            of = np.repeat(part, size)
            if len(of):
                yield i[of], last[of] - np.repeat(np.cumsum(size), size) + 1 + np.arange(len(of))


def spans_of(text: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes of the texts that are covered by the strings at ranges of starts."""
    order = np.lexsort((first, text))
    text, at = text[order], text[order] * (1 << 40)
    start, end = at + first[order], np.maximum.accumulate(at + last[order] + LENGTH)
    fresh = np.ones(len(text), bool)
    fresh[1:] = start[1:] > end[:-1]
    final = np.ones(len(text), bool)
    final[:-1] = fresh[1:]
    return text[fresh], (start - at)[fresh], end[final] - at[final]


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for start, end in spans:
        out.append(data[at:start])
        at = end
    return b"".join([*out, data[at:]])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Returns (doc_id, key, n_bytes, sha, copies) for each row, and for each text with an
    anchor that matters (key, text, ranges, starts): where repeated strings start."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    rows = source.select(
        "doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")
    )
    rows = cut(rows)
    firsts = rows.groupBy("key").agg(F.count("*").alias("copies"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("of"))
    firsts = cut(firsts.select("key", "copies", "of.doc_id"))

    spark = docs.sparkSession
    folder = new_folder(spark, "repeats")
    sample = stored(_sampled(source.select("key", "text")), f"{folder}/sample")
    involved = _repeated(sample, "run").select("key").distinct().join(firsts, "key").select("key", "doc_id")
    match = (F.col("s.key") == F.col("i.key")) & F.col("s.doc_id").eqNullSafe(F.col("i.doc_id"))
    # Rows that repeat both id and text are one here.
    texts = source.alias("s").join(involved.alias("i"), match).groupBy("i.key").agg(F.min("s.text").alias("text"))
    texts = stored(texts, f"{folder}/texts")
    remove(f"{folder}/sample")

    found = stored(_anchored(texts), f"{folder}/anchors")
    lists = _texts_of_anchors(_repeated(found, "context"))
    remove(f"{folder}/anchors")
    total, depth = lists.agg(F.sum("symbols"), F.max("depth")).first()
    prefixes = _common_prefixes(lists, total or 0, depth, folder).groupBy("key").agg(F.collect_list(F.struct("i", "low", "high")).alias("p"))
    prefixes = prefixes.select("key", F.col("p.i").alias("at"), "p.low", "p.high")
    texts = texts.withColumn("n_bytes", F.octet_length("text").cast("long"))
    cells = cut(lists.select("key", *_ANCHOR_LISTS, "alike").join(prefixes, "key", "left").join(texts, "key"))
    remove(folder)
    return rows.join(firsts.select("key", "copies"), "key"), _decided(cells)


def _decided(cells: DataFrame) -> DataFrame:
    """Adds the starts that the suffix array leaves open."""
    hint = pa.schema([("key", pa.int64()), ("chunk", pa.int64()), ("core", pa.int64()), ("open", pa.bool_())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, texts = Starts.of(batch), batch.column("text").cast(pa.binary()).to_pylist()
            left, known = (own.chunks(*ranges) for ranges in own.open())
            chunks = np.union1d(left, known)
            i, c = chunks // CHUNK, chunks % CHUNK
            text, at = own.text[i], own.pos[i] - CHUNK * c
            cores = [
                xxhash.xxh3_64_intdigest(texts[t][a : a + LENGTH - CHUNK + 1], seed) >> 1
                for t, a, seed in zip(text.tolist(), at.tolist(), c.tolist(), strict=True)
            ]
            columns = [batch.column("key").to_numpy()[text], own.index()[i] * CHUNK + c, np.array(cores, np.int64), np.isin(chunks, left)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=hint)

    slim = cells.select("key", "text", "n_bytes", *_ANCHOR_LISTS, "alike", *_PREFIXES)
    asked = cut(slim.mapInArrow(ask, "key long, chunk long, core long, open boolean"))
    cores = asked.groupBy("core").agg(F.count("*").alias("n"), F.max("open").alias("some")).where("n > 1 and some").select("core")
    wanted = asked.join(cores, "core", "left_semi").groupBy("key").agg(F.collect_list("chunk").alias("wanted"))
    chosen = cells.join(wanted, "key")
    # Counted without their places; those of open starts are worked out again for what is left.
    counted = chosen.mapInArrow(_hash_strings(False), "string long, more long, open boolean")
    twice = counted.groupBy("string", "more").agg(F.count("*").alias("n"), F.max("open").alias("some"))
    twice = twice.where("n > 1 and some").select("string", "more")
    places = chosen.mapInArrow(_hash_strings(True), "string long, more long, key long, start long")
    starts = places.join(twice, ["string", "more"], "left_semi").groupBy("key").agg(F.collect_list("start").alias("starts"))
    return cells.join(starts, "key", "left")


def _hash_strings(placed: bool):
    """Hashes of the strings at open starts, with their places, or at open and known ones."""
    long = pa.int64()
    kind = pa.schema([("string", long), ("more", long), *([("key", long), ("start", long)] if placed else [("open", pa.bool_())])])

    def hash_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, texts = Starts.of(batch), batch.column("text").cast(pa.binary()).to_pylist()
            chunk, row = _flat(batch, "wanted")
            wanted = np.zeros(len(own.pos) * CHUNK, bool)
            wanted[np.searchsorted(own.text, row) * CHUNK + chunk] = True
            keys = batch.column("key").to_numpy()
            for told, ranges in zip((True, False), own.open(), strict=True):
                if placed and not told:
                    continue
                some = wanted.reshape(-1, CHUNK).any(axis=1)[ranges[0]]
                for i, starts in own.expanded(*(x[some] for x in ranges)):
                    good = wanted[own.chunk(i, starts)]
                    text, starts = own.text[i[good]], starts[good]
                    found = [xxhash.xxh3_128_digest(texts[t][a : a + LENGTH]) for t, a in zip(text.tolist(), starts.tolist(), strict=True)]
                    high, low = np.frombuffer(b"".join(found), ">u8").astype(np.uint64).reshape(-1, 2).T
                    rest = [keys[text], starts] if placed else [np.full(len(found), told)]
                    columns = [(low & np.uint64(_LOW)).astype(np.int64), (high >> np.uint64(32)).astype(np.int64), *rest]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=kind)

    return hash_strings


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans."""
    rows, texts = find(docs, id_col, text_col)

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, rows = Starts.of(batch), batch.num_rows
            anchor, first, last = own.repeats()
            starts, row = _flat(batch, "starts")
            text = np.concatenate((own.text[anchor], row))
            text, start, end = spans_of(text, np.concatenate((first, starts)), np.concatenate((last, starts)))
            count, removed = np.bincount(text, minlength=rows), np.bincount(text, end - start, rows).astype(np.int64)
            offsets = np.concatenate(([0], np.cumsum(count)))
            bounds = list(zip(start.tolist(), end.tolist(), strict=True))
            digests = [
                hashlib.sha256(without(data, bounds[a:b])).hexdigest()
                for data, a, b in zip(batch.column("text").cast(pa.binary()).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            ]
            pairs = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(start) + 1, 2), pa.int32()), pa.array(np.stack((start, end), 1).ravel(), pa.int64()))
            spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)
            columns = [batch.column("key"), pa.array(removed), pa.array(count, pa.int64()), pa.array(digests, pa.string()), spans]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "removed", "count", "digest", "spans"])

    cuts = texts.mapInArrow(cut_out, "key long, removed long, count long, digest string, spans array<array<long>>")
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    nothing = F.array().cast("array<array<long>>")
    whole = F.array(F.array(F.lit(0).cast("long"), F.col("n_bytes")))
    return rows.join(cuts, "key", "left").select(
        "doc_id",
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("count", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("digest", "sha")).alias("kept_sha256"),
        F.when(copied, whole).otherwise(F.coalesce("spans", nothing)).alias("spans"),
    )
