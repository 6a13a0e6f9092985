import random

import pytest

CLASHES = ("start", "kept", "slot", "place", "epoch", "found", "node", "tag", "key", "root", "n", "pos", "label", "template", "_found", "_key")


@pytest.fixture(scope="session")
def table(spark):
    """Rows as a frame in three partitions, with extra columns that clash with the operators' own."""

    def make(rows, schema):
        extra = ", ".join(f"{name} string" for name in CLASHES)
        wide = [(*row, *["x"] * len(CLASHES)) for row in rows]
        return spark.createDataFrame(wide, f"{schema}, {extra}").repartition(3)

    return make


@pytest.fixture(scope="session")
def docs(table):
    def make(rows):
        """(doc_id, text) or (doc_id, text, lang, source)."""
        full = [(*row, None, None)[:4] for row in rows]
        return table([(i, t, lang, source, len(t or "")) for i, t, lang, source in full], "doc_id long, text string, lang string, source string, n_chars long")

    return make


@pytest.fixture(scope="session")
def prose():
    def make(words, seed, vocabulary=400):
        draw = random.Random(seed)
        names = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 8))) for _ in range(vocabulary)]
        return " ".join(draw.choice(names) for _ in range(words))

    return make


@pytest.fixture(scope="session")
def long_text(prose):
    return prose(30_000, 99, 5000)
