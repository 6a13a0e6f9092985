"""Spelling variants of the words of a corpus, by a trie of letter frequencies.

A word's letters fall into ``LEVELS`` groups, by the last five bits of their code points.
One edit (a letter put in, left out or replaced) raises the count of at most one group by
one and lowers that of at most one other by one. A trie arranges the words by the counts of
one group after the other. A depth-first search takes the asking words down the trie
together: into a child go those whose own count is that of the child, and those that are one
below it (the surplus) or one above it (the deficit) and have not spent that yet. Each node is
visited once for all of them. The words of the leaves are verified letter by letter.

The trie is cut for Spark at its top, where the groups are taken together into ``TOP``
coarser ones whose counts obey the same budget. A word asks its own subtrie and those within
the budget whose counts come later in order, so that each pair is met once. A subtrie of many
words is cut into parts, and the words that ask it are dealt into turns, so that a task
holds ``PART`` words and ``TURN`` asking ones at a time. At the full depth a leaf can hold very
many anagrams; there the edits of a word that lead to the leaf's counts are looked up
instead of comparing all its words.

Defined results: null texts have no words, a null id counts as empty text in the draw; equal
rows count as often as they come. Words have no bound of length. An empty corpus gives no
rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batched, cut, rows_of

LEVELS, TOP = 32, 3
WIDTH = 32  # words up to this length are compared many at a time
LEAF, PAIRS = 8, 1024  # a node of so few words, or of so few pairs with asking words, is a leaf
PART, TURN = 20_000, 20_000
MOST_COUNTED = 200_000  # words a task counts before it hands them on
PIECE = 1 << 20

#: Runs of letters, and the draw that leaves out a letter.
LETTERS = "a-zÀ-ÿ"
ONE_IN = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3


def _pieces(text: str, gap: re.Pattern) -> Iterator[str]:
    """The text in pieces that end between two words."""
    at = 0
    while at < len(text):
        end = gap.search(text, at + PIECE)
        end = end.start() if end else len(text)
        yield text[at:end]
        at = end


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, one_in: int | None = ONE_IN
) -> DataFrame:
    """(word, n) of the whole texts, for words of ``least_length`` letters and more. A-Z are
    lower-cased. Of the words of a document one in ``one_in`` loses a letter: where that
    number divides the CRC-32 of ``<id>:<word>``, the letter at that CRC modulo its length."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A shorter run than this can't give a word; longer ones are matched whole.
        run, gap = re.compile(f"[{LETTERS}]{{{least_length},}}"), re.compile(f"[^{LETTERS}]")

        def out() -> Iterator[tuple]:
            sums: Counter = Counter()
            for doc, text in rows_of(batches, "id", "text"):
                own: Counter = Counter()
                for piece in _pieces((text or "").encode().lower().decode(), gap):
                    own.update(run.findall(piece))
                start = zlib.crc32(f"{doc}:".encode())
                for word, n in own.items():
                    drawn = zlib.crc32(word.encode(), start)
                    if one_in and drawn % one_in == 0:
                        at = drawn % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    sums[word] += n
                if len(sums) >= MOST_COUNTED:
                    yield from sums.items()
                    sums.clear()
            yield from sums.items()

        yield from batched(out(), kind)

    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vectors(words: list[str]) -> np.ndarray:
    """How many letters of each group every word has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32) % LEVELS
    places = np.repeat(np.arange(len(words)) * LEVELS, sizes) + letters
    return np.bincount(places, minlength=len(words) * LEVELS).reshape(-1, LEVELS).astype(np.int32)


def subtrie(word: str) -> tuple[int, ...]:
    counts = [0] * TOP
    for letter in word:
        counts[ord(letter) % LEVELS % TOP] += 1
    return tuple(counts)


def reachable(top: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
    """The counts within the budget of ``top`` that don't come before it."""
    for up in range(-1, TOP):
        for down in range(-1, TOP):
            if up == down and up >= 0:
                continue
            moved = list(top)
            if up >= 0:
                moved[up] += 1
            if down >= 0:
                moved[down] -= 1
            if tuple(moved) >= top and min(moved) >= 0:
                yield tuple(moved)


def one_apart(a: str, b: str) -> bool:
    """Whether one letter put in, left out or replaced makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def spelled(words: list[str]) -> np.ndarray:
    """The code points of each word up to ``WIDTH``, filled up with zeros."""
    data = "".join(w[:WIDTH].ljust(WIDTH, "\0") for w in words).encode("utf-32-le")
    return np.frombuffer(data, np.uint32).reshape(-1, WIDTH)


def all_one_apart(a: np.ndarray, b: np.ndarray, more: np.ndarray) -> np.ndarray:
    """:func:`one_apart` for the rows of two matrices of code points; ``more`` says how many
    letters ``b`` has more than ``a``: -1, 0 or 1."""
    differ = a != b
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), WIDTH)
    out = (more == 0) & (differ.sum(axis=1) == 1)
    for sign, short, long in ((1, a, b), (-1, b, a)):
        rows = np.flatnonzero(more == sign)
        if len(rows):
            # What follows the first difference agrees, moved by one.
            moved = short[rows, :-1] != long[rows, 1:]
            last = np.where(moved.any(axis=1), WIDTH - 2 - moved[:, ::-1].argmax(axis=1), -1)
            out[rows] = last < first[rows]
    return out


class Trie:
    """Words in order of their counts, the groups that tell most first: a node is a range of
    rows that agree in the groups so far."""

    def __init__(self, words: list[str]):
        counts = vectors(words)
        self.order = np.argsort(-counts.var(axis=0), kind="stable")
        counts = counts[:, self.order]
        rows = np.lexsort(counts.T[::-1])
        self.words, self.counts = [words[i] for i in rows], counts[rows]
        self.rows, self.odd, self.size = rows, _odd(self.counts), self.counts.sum(axis=1)
        self.spelled = spelled(self.words)

    def near(self, asking: list[str]) -> Iterator[tuple[int, int]]:
        """(asking word, word) by their places: all pairs that are one edit apart."""
        counts = vectors(asking)[:, self.order]
        odd, size, letters = _odd(counts), counts.sum(axis=1), spelled(asking)
        none = np.zeros(len(asking), bool)
        waiting = [(0, len(self.words), 0, np.arange(len(asking)), none, none)]
        while waiting:
            low, high, level, who, up, down = waiting.pop()
            if level == LEVELS and high - low > 4 * LEAF:
                yield from self._anagrams(low, high, who, asking, counts)
                continue
            if level == LEVELS or high - low <= LEAF or (high - low) * len(who) <= PAIRS:
                # The groups that are left are compared by whether their counts are odd, then in full.
                close = np.bitwise_count(odd[who][:, None] ^ self.odd[low:high]) <= 2
                close &= abs(size[who][:, None] - self.size[low:high]) <= 1
                left, right = np.nonzero(close)
                left, right = who[left], right + low
                fits = np.abs(counts[left] - self.counts[right]).sum(axis=1) <= 2
                left, right = left[fits], right[fits]
                more = self.size[right] - size[left]
                short = (self.size[right] <= WIDTH) & (size[left] <= WIDTH)
                found = short.copy()
                found[short] = all_one_apart(letters[left[short]], self.spelled[right[short]], more[short])
                for at in np.flatnonzero(~short):
                    found[at] = one_apart(asking[left[at]], self.words[right[at]])
                yield from zip(left[found].tolist(), self.rows[right[found]].tolist(), strict=True)
                continue
            column, own = self.counts[low:high, level], counts[who, level]
            starts = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), high - low]
            for start, end in zip(starts, starts[1:], strict=False):
                more = column[start] - own
                go = np.flatnonzero((more == 0) | ((more == 1) & ~up) | ((more == -1) & ~down))
                if len(go):
                    waiting.append((low + start, low + end, level + 1, who[go], up[go] | (more[go] == 1), down[go] | (more[go] == -1)))

    def _anagrams(self, low: int, high: int, who: np.ndarray, asking: list[str], counts: np.ndarray) -> Iterator[tuple[int, int]]:
        """A leaf at the full depth with many words: edits are looked up."""
        place = {self.words[j]: int(self.rows[j]) for j in range(low, high)}
        letters: dict[int, set[str]] = defaultdict(set)
        for word in place:
            for letter in word:
                letters[ord(letter) % LEVELS].add(letter)
        for i in who.tolist():
            word, more = asking[i], self.counts[low] - counts[i]
            up, down = (self.order[np.flatnonzero(more == x)].tolist() for x in (1, -1))
            found = set()
            if up and not down:
                found = {word[:at] + x + word[at:] for at in range(len(word) + 1) for x in letters[up[0]]}
            else:
                for at, own in enumerate(word):
                    group = ord(own) % LEVELS
                    if not down or down[0] == group:
                        put = letters[up[0] if up else group] if up or not down else [""]
                        found.update(word[:at] + x + word[at + 1 :] for x in put if x != own)
            yield from ((i, place[w]) for w in found if w in place)


def _odd(counts: np.ndarray) -> np.ndarray:
    """A bit for each group that has an odd number of letters."""
    return ((counts & 1).astype(np.uint64) << np.arange(LEVELS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _dealt(words: DataFrame) -> DataFrame:
    """Rows (shard, part, turn, asks, home, word, n): the words of each part of a subtrie, and
    those that ask it."""
    kind = pa.schema([("word", pa.string()), ("n", pa.int64()), ("own", pa.string()), ("asked", pa.list_(pa.string()))])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def name(top: tuple[int, ...]) -> str:
            return " ".join(map(str, top))

        def out() -> Iterator[tuple]:
            for word, n in rows_of(batches, "word", "n"):
                top = subtrie(word)
                yield word, n, name(top), [name(x) for x in reachable(top)]

        yield from batched(out(), kind)

    placed = cut(words.mapInArrow(place, "word string, n long, own string, asked array<string>"))
    sizes = placed.groupBy(F.col("own").alias("shard")).agg(F.ceil(F.count("*") / F.lit(PART)).cast("int").alias("parts"))
    asks = placed.select("word", "n", F.explode("asked").alias("shard"), "own")
    asking = asks.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(TURN)).cast("int").alias("turns"))
    sizes = cut(sizes.join(asking, "shard"))
    turns, parts = (F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("turns", "parts"))
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("part")
    turn = F.pmod(F.xxhash64("word", F.lit(1)), F.col("turns")).cast("int").alias("turn")
    held = placed.select("word", "n", F.col("own").alias("shard")).join(sizes, "shard")
    held = held.select("shard", part, turns.alias("turn"), F.lit(False).alias("asks"), F.lit(False).alias("home"), "word", "n")
    asks = asks.join(sizes, "shard")
    asks = asks.select("shard", parts.alias("part"), turn, F.lit(True).alias("asks"), (F.col("own") == F.col("shard")).alias("home"), "word", "n")
    return held.union(asks)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of words one edit apart, both ways. ``words`` has
    distinct words with a number n."""
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell = ["shard", "part", "turn"]
    rows = _dealt(words).repartition(tasks, *cell).sortWithinPartitions(*cell, "asks")
    kind = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def met(held: list[tuple], asking: list[tuple]) -> Iterator[tuple]:
            if not held or not asking:
                return
            for i, j in Trie([word for word, _ in held]).near([word for word, _, _ in asking]):
                (word, n, home), (other, other_n) = asking[i], held[j]
                # Within its own subtrie a pair is met from both sides.
                if not home or word < other:
                    yield word, n, other, other_n
                    yield other, other_n, word, n

        def out() -> Iterator[tuple]:
            at, held, asking = None, [], []
            for shard, part, turn, asks, home, word, n in rows_of(batches, *cell, "asks", "home", "word", "n"):
                if (shard, part, turn) != at:
                    yield from met(held, asking)
                    at, held, asking = (shard, part, turn), [], []
                if asks:
                    asking.append((word, n, home))
                else:
                    held.append((word, n))
            yield from met(held, asking)

        yield from batched(out(), kind)

    return rows.mapInArrow(search, "word string, n long, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form on the way from each word. Forms are at least twice as
    frequent as their words, so there are no circles and few steps; they double with every turn."""
    chain = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = chain.select(F.col("word").alias("root"), F.col("root").alias("up"))
        chain = cut(chain.join(further, "root", "left").select("word", F.coalesce("up", "root").alias("root"), "up"))
        if not chain.where("up is not null").limit(1).count():
            return chain.drop("up")
        chain = chain.drop("up")


def variants(words: DataFrame, times: Column | int = 2) -> DataFrame:
    """Of words (word, n): the near word of largest n as ``form`` (ties: the first by code
    points), where it is ``times`` as frequent at least; the number of near words; and the end of
    the way from form to form."""
    words = cut(words.select("word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    found = near_words(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    form_n = -F.col("best.less")
    good = form_n >= F.lit(times) * F.col("n")
    found = cut(found.select("word", "n_near", F.when(good, F.col("best.near")).alias("form"), F.when(good, form_n).alias("form_n")))
    roots = _roots(found.where("form is not null"))
    out = words.join(found, "word", "left").join(roots, "word", "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )


def report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT
) -> DataFrame:
    """The variants among the words of ``docs`` that come ``least_count`` times at least."""
    return variants(word_counts(docs, id_col, text_col, least_length).where(F.col("n") >= least_count))
