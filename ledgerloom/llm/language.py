"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +-1. A three-letter run is bound into one vector:
the letters' vectors, rotated by their place in the run, multiplied element by element.
A text is the bundle (sum) of its runs, a language the bundle of its documents, each
divided by its number of runs. The prototypes are centred, as all languages share most of
their runs, and a text gets the language with the largest cosine.

Runs are counted before they are bound: the bundle of a language is the sum of its run
counts times the runs' vectors, so training is one grouped sum in Spark, and what
comes to the driver is bounded by languages times ``SYMBOLS ** 3`` runs.

Defined results: a text that is null or has no letter is ``und`` with score 0; rows
without a language, or with none at all to learn from, teach nothing; with no
language learned, every text is ``und``; ties go to the language first in order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batched, free_name, held, rows_of

UNKNOWN = "und"
DIMENSIONS = 256
TABLE_RUNS = 40_000
SYMBOLS = 64
MOST_LANGUAGES = 500
#: A document's weight, dealt to its runs. Sums of whole numbers don't depend on the
#: order of the tasks.
SHARE = 1_000_000
SEED = 20
#: Limits: steps of the score, and rows that a class of lengths must have.
STEPS = 1000
LEAST_ROWS = 20


def _letter_codes() -> np.ndarray:
    """Code points below 0x3000 to symbols: 0 no letter, 1 to 26 a to z, others by a
    multiplicative hash into the rest. Case is folded."""
    codes = np.zeros(0x3000, np.int32)
    for point in range(len(codes)):
        if chr(point).isalpha():
            low = chr(point).lower()
            own = ord(low[0])
            codes[point] = own - 96 if 97 <= own <= 122 else 27 + own * 2654435761 % 2**32 % (SYMBOLS - 27)
    return codes


class Profiles:
    """Texts to runs, runs to vectors, vectors to languages."""

    def __init__(self, languages: list[str] = (), prototypes: np.ndarray | None = None):
        self.codes = _letter_codes()
        self.letters = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMENSIONS))
        self.turned = [np.roll(self.letters, shift, axis=1) for shift in range(3)]
        self.languages, self.prototypes = list(languages), prototypes
        self.common = np.zeros(0, np.int64)
        self.place = np.full(SYMBOLS**3, -1, np.int32)
        self.table = np.zeros((0, DIMENSIONS), np.float32)

    def prepare(self, runs: np.ndarray) -> None:
        """Keep the vectors of common runs; the others are bound when they are met."""
        runs = runs[:TABLE_RUNS]
        self.place[runs] = np.arange(len(runs))
        self.table = self.vectors(runs).astype(np.float32)

    def runs(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the text's three-letter runs, words framed by spaces, and their counts."""
        if not text:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.codes[np.minimum(points, len(self.codes) - 1)]
        if (points >= len(self.codes)).any():
            far = points >= len(self.codes)
            codes[far] = [27 + int(p) % (SYMBOLS - 27) if chr(p).isalpha() else 0 for p in points[far]]
        framed = np.zeros(len(codes) + 2, np.int64)
        framed[1:-1] = codes
        # No two spaces in a row.
        kept = framed[np.concatenate(([True], (framed[1:] != 0) | (framed[:-1] != 0)))]
        if len(kept) < 3:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.unique((kept[:-2] * SYMBOLS + kept[1:-1]) * SYMBOLS + kept[2:], return_counts=True)

    def vectors(self, runs: np.ndarray) -> np.ndarray:
        """The bound vector of each run."""
        a, b, c = runs // (SYMBOLS * SYMBOLS), runs // SYMBOLS % SYMBOLS, runs % SYMBOLS
        return self.turned[2][a] * self.turned[1][b] * self.turned[0][c]

    def bundle(self, runs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(DIMENSIONS)
        for at in range(0, len(runs), 8192):
            some, weight = runs[at : at + 8192], weights[at : at + 8192].astype(np.float32)
            place = self.place[some]
            far = place < 0
            if far.any():
                out += weight[far] @ self.vectors(some[far]).astype(np.float32)
                place, weight = place[~far], weight[~far]
            out += weight @ self.table[place]
        return out

    def predict(self, text: str | None) -> tuple[str, float, int]:
        """Language, score and how much the text tells: the logarithm to base 2 of the
        number of its runs, where repeated ones count for less (sum squared by squares)."""
        runs, counts = self.runs(text)
        if not len(runs) or not self.languages:
            return UNKNOWN, 0.0, 0
        told = int(math.log2(counts.sum() ** 2 / (counts * counts).sum()))
        own = self.bundle(runs, counts)
        near = self.prototypes @ (own / max(np.linalg.norm(own), 1e-9))
        best = int(np.argmax(near))
        return self.languages[best], float(np.clip((1 + near[best]) / 2, 0, 1)), told


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Prototypes of all rows that have a language."""
    rows = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    kind = pa.schema([("lang", pa.string()), ("run", pa.int64()), ("weight", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles, sums = held(("profiles",), Profiles), {}
        for lang, text in rows_of(batches, "lang", "text"):
            runs, counts = profiles.runs(text)
            if len(runs):
                if lang not in sums:
                    if len(sums) >= MOST_LANGUAGES:
                        raise ValueError(f"more than {MOST_LANGUAGES} languages")
                    sums[lang] = np.zeros(SYMBOLS**3, np.int64)
                sums[lang][runs] += counts * SHARE // counts.sum()
        yield from batched(((k, int(r), int(v[r])) for k, v in sums.items() for r in np.flatnonzero(v)), kind)

    found = rows.mapInArrow(count, "lang string, run long, weight long")
    total = found.groupBy("lang", "run").agg(F.sum("weight").alias("weight"))
    table = total.toArrow()
    langs = np.array(table["lang"].to_pylist(), object)
    names = sorted(set(langs))
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    profiles, runs, weights = Profiles(), table["run"].to_numpy(), table["weight"].to_numpy()
    sums = np.zeros((len(names), DIMENSIONS))
    for i, name in enumerate(names):
        own = np.flatnonzero(langs == name)
        own = own[np.argsort(runs[own])]
        sums[i] = profiles.bundle(runs[own], weights[own])
    sums /= np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    if len(names) > 1:
        sums -= sums.mean(axis=0)
        sums /= np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    out = Profiles(names, sums)
    out.common = np.unique(runs)
    return out


def predict(docs: DataFrame, profiles: Profiles, text_col: str = "text", out: str = "found", told: bool = False) -> DataFrame:
    """``docs`` with a struct column ``out`` of lang and score, and ``told`` if asked for: the
    class of texts by the number of their runs that limits are made for."""
    names = ["lang", "score", "told"][: 2 + told]
    model = docs.sparkSession.sparkContext.broadcast((profiles.languages, profiles.prototypes, profiles.common))

    @F.pandas_udf("lang string, score double" + ", told int" * told)
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages, prototypes, common = model.value
        own = Profiles(languages, prototypes)
        own.prepare(common)
        for texts in batches:
            yield pd.DataFrame([own.predict(t)[: len(names)] for t in texts], columns=names)

    # Called non-deterministic, or a filter on the result would have every text scored once more.
    return docs.withColumn(out, guess.asNondeterministic()(F.col(text_col).cast("string")))


def letters(text: Column) -> Column:
    """How many letters a text has."""
    return F.length(F.regexp_replace(text.cast("string"), r"\P{L}+", ""))


def _found_right(docs: DataFrame, profiles: Profiles, text_col: str, lang_col: str) -> DataFrame:
    """(told, step) of the labelled rows whose language is found right."""
    name = free_name(docs, "found")
    rows = predict(docs.where(F.col(lang_col).isNotNull()), profiles, text_col, name, told=True)
    rows = rows.where((F.col(name)["lang"] != UNKNOWN) & (F.col(name)["lang"] == F.col(lang_col).cast("string")))
    return rows.select(F.col(name)["told"].alias("told"), F.floor(F.col(name)["score"] * STEPS).alias("step"))


def limits(docs: DataFrame, profiles: Profiles, text_col: str = "text", lang_col: str = "lang") -> list[float | None]:
    """The score under which a text is like no learned language, by class: texts of
    ``2 ** n`` runs and more, up to twice as many, where repeated runs count for less. It is
    the lowest score of a row whose language is found right, or three times the distance
    of the quartiles of these rows below the lower one (Tukey's outer fence) if that is
    less: no such row is under its limit. A class of fewer than ``LEAST_ROWS`` rows takes the
    limit of the next shorter class, whose texts score lower; if there is none, it has
    no limit."""
    # Bounded by the classes and the steps.
    counts: dict[int, list[tuple[int, int]]] = {}
    for r in _found_right(docs, profiles, text_col, lang_col).groupBy("told", "step").count().collect():
        counts.setdefault(r["told"], []).append((r["step"], r["count"]))
    out: list[float | None] = []
    for own in range(max(counts, default=-1) + 1):
        steps = sorted(counts.get(own, []))
        total = np.cumsum([n for _, n in steps])
        if not steps or total[-1] < LEAST_ROWS:
            out.append(out[-1] if out else None)
            continue
        low, high = (steps[int(np.searchsorted(total, total[-1] * q))][0] for q in (0.25, 0.75))
        out.append(min(steps[0][0], low - 3 * (high + 1 - low)) / STEPS)
    return out


def alike(found: Column, limits: list[float | None]) -> Column:
    """Whether a prediction is one of a language, with a score that reaches the limit of its class."""
    known = F.array(*(F.lit(x).cast("double") for x in limits or [None]))
    limit = F.element_at(known, F.least(found["told"] + 1, F.lit(max(len(limits), 1))))
    return (found["lang"] != UNKNOWN) & F.coalesce(found["score"] >= limit, F.lit(True))


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that is not learned from: a quarter of the ids, by their hash."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
