import random
import zlib

from pyspark.sql import functions as F

from ledgerloom.llm import language
from ledgerloom.llm.queries import op7_language_id

SYLLABLES = {"aa": ["the", "ing", "er", "and", "wh"], "bb": ["que", "ción", "ado", "es", "ñ"], "cc": ["sch", "ung", "ein", "ü", "ich"]}


def written(lang, words, seed):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 4))) for _ in range(words))


def corpus(long_text):
    rows = [(i, written(lang := "abc"[i % 3] * 2, 5 + i % 40, i), lang, "s") for i in range(300)]
    rows += [(1000, None, "aa", None), (1001, "", "bb", None), (1002, "123 !? 4", "aa", None), (1003, written("bb", 30, 1), None, None)]
    return rows + [(1004, "日本語 の 文", None, None), (1005, long_text, None, None), (1, written("aa", 9, 2), "aa", "s"), (None, written("cc", 20, 3), None, None)]


def test_held_out_accuracy(docs, long_text):
    frame = docs(corpus(long_text))
    profiles = language.learn(frame.where(~language.held_out()))
    assert profiles.languages == ["aa", "bb", "cc"]
    found = language.predict(frame.withColumn("out", language.held_out()), profiles, out="guess").collect()
    assert len(found) == len(corpus(long_text))
    held = [r for r in found if r["out"] and r.lang]
    assert len(held) > 50 and sum(r.guess.lang == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.guess.score <= 1 for r in found)
    got = {r.doc_id: r.guess.lang for r in found}
    assert got[1000] == got[1001] == got[1002] == "und"
    assert got[1003] == "bb" and got[None] == "cc" and got[1004] in profiles.languages


def test_fold_is_the_checksum_of_the_id(docs):
    found = docs([(i, "x") for i in [0, 1, 2, 77, -5, 10**12, None]]).select("doc_id", language.held_out().alias("f")).collect()
    assert all(r.f == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)


def test_nothing_to_learn(spark, docs):
    empty = language.learn(docs([(1, "abc", None, None), (2, "12", "aa", None)]))
    assert empty.languages == []
    assert [tuple(r.f) for r in language.predict(docs([(1, "abc")]), empty, out="f").collect()] == [("und", 0.0)]
    assert language.predict(docs([]), empty, out="f").count() == 0


def test_query_reads_no_label_of_the_fold(spark, docs, tmp_path, long_text):
    """Changing the languages of the held-out rows changes no prediction."""
    rows = corpus(long_text)
    swapped = [(i, t, "zz" if i is not None and zlib.crc32(str(i).encode()) % 4 == 2 else lang, s) for i, t, lang, s in rows]
    got = []
    for name, some in (("a", rows), ("b", swapped)):
        docs(some).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got.append(sorted(map(tuple, op7_language_id(spark, f"{tmp_path}/{name}").collect()), key=repr))
    assert got[0] == got[1]


def test_texts_are_scored_once(docs):
    """A filter on the result is no reason to score the texts again."""
    frame = docs([(i, written("ab"[i % 2] * 2, 30, i), "ab"[i % 2] * 2, None) for i in range(20)])
    profiles = language.learn(frame)
    limited = language.predict(frame, profiles, told=True).where(language.alike(F.col("found"), [0.5, None]))
    for found in (limited, limited.drop("found"), language._found_right(frame, profiles, "text", "lang")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
