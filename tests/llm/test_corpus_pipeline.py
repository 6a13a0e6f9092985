import random
import zlib
from collections import Counter

import corpus_pipeline
import pytest
from ledgerloom.llm import token_records
from ledgerloom.llm.queries import queries, tokenizer_path
from tests.llm.test_language import written
from tests.llm.test_near_duplicates import brute, edited


@pytest.fixture(scope="module")
def tables(spark, docs, prose, tmp_path_factory):
    """Documents with one flaw each, and clean ones."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    item = prose(14, 5000, 900)
    rows = [(i, prose(60 + i, i, 900), "xx", f"s{i % 3}" if i % 7 else None) for i in range(40)]
    rows += [(100 + i, edited(rows[i][1], 0.01, i), "xx", "s0") for i in range(10)]
    rows += [(200 + i, f"{prose(30, 900 + i, 900)} {item} {prose(30, 950 + i, 900)}", "xx", "s1") for i in range(5)]
    rows += [(300, None, "xx", "s1"), (301, "", "xx", "s1"), (302, "12 34 !!", "xx", "s1"), (0, rows[0][1], "xx", "s0")]
    docs(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_each_stage_does_its_work(spark, tables):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        kept[name] = Counter(r.doc_id for r in docs.collect())
    lettered = [(i, t) for i, t, *_ in rows if t and any(c.isalpha() for c in t)]
    assert set(kept["language"]) == {i for i, _ in lettered}
    groups = brute(list(dict(lettered).items()), 5, 80)
    firsts = {i for i, (_, least) in groups.items() if i == least}
    assert kept["near duplicates"] == Counter(firsts)
    clean = {i for i in firsts if not 200 <= i < 300}
    assert kept["decontamination"] == Counter(clean)
    assert set(kept["mix"]) == clean


def test_run_equals_its_stages(spark, tables):
    folder, _ = tables
    found = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    own = token_records.Encoder(tokenizer_path())
    want = sorted((r.doc_id, len(own.whole(r.text)) // 2 + 1) for r in docs.collect())
    assert [(r.doc_id, r.n_tokens) for r in sorted(found, key=lambda r: r.start)] == want
    starts = sorted(found, key=lambda r: r.start)
    assert [r.start for r in starts] == [sum(r.n_tokens for r in starts[:i]) for i in range(len(starts))]


def test_records_know_their_place_in_the_mix(spark, docs, tmp_path):
    """Whole blocks of every source: read by position, no prefix is a block off the weights."""
    sizes, rows = {"big": 640, "small": 64, "least": 16}, []
    for name, n in sizes.items():
        rows += [(len(rows) + i, f"{name} {i}", "xx", name) for i in range(n)]
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        corpus_pipeline.target_mix(spark, docs(rows), "").write.parquet(f"{tmp_path}/mixed")
    finally:
        spark.conf.unset("spark.sql.shuffle.partitions")
    mixed = spark.read.parquet(f"{tmp_path}/mixed")
    found = sorted(corpus_pipeline.token_records(spark, mixed, "").collect(), key=lambda r: r.position)
    assert [r.position for r in found] == list(range(mixed.count()))
    assert len(found) > len(rows)  # small sources repeat
    weights = {name: (n // 16) ** 0.7 for name, n in sizes.items()}
    done, total = Counter(), sum(weights.values())
    for nth, r in enumerate(found, 1):
        done[rows[r.doc_id][3]] += 1
        assert all(abs(done[k] - nth * w / total) < 16 for k, w in weights.items())


def test_language_stage_rejects_what_no_language_is_like(spark, docs):
    rows = [(i, written(lang := "abc"[i % 3] * 2, 5 + i % 60, i), lang, "s") for i in range(900)]
    strange = {2000: ["жшщ", "ъыэ", "юфц", "лпй", "кг", "мяь"], 3000: ["zxk", "vqj", "jwq", "kkz", "xv", "wzq"]}
    draw = random.Random(4)
    alien = [(at + i, " ".join("".join(draw.choices(some, k=draw.randint(1, 4))) for _ in range(20 + i)), None, "s") for at, some in strange.items() for i in range(20)]
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, docs(rows + alien), "").collect()}
    assert not kept & {r[0] for r in alien}
    assert len(kept) >= 0.99 * len(rows)


def test_language_stage_without_labels_keeps_what_has_letters(spark, docs):
    """No label at all, and labels in the held-out fold only."""
    rows = [(1, "some words", None, "s"), (2, "12 !", None, "s"), (3, None, None, "s"), (4, "é", None, "s")]
    held = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 4 == 2)
    for some in (rows, [*rows, (held, "more words", "xx", "s")]):
        found = corpus_pipeline.known_language(spark, docs(some), "")
        assert found.columns == docs(some).columns
        assert {r.doc_id for r in found.collect()} == {1, 4} | {r[0] for r in some[4:]}


def test_stage_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near duplicates", "decontamination", "mix", "tokens"]


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries()) == list(range(1, 14))


def test_empty_documents(spark, docs, tmp_path):
    docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


