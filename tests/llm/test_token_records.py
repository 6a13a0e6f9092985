import io
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import common, token_records
from ledgerloom.llm.queries import tokenizer_path, tokens

ODD = [
    "a  b", " a b", "a b ", "a \n b", "it's 's  x", "x <|endoftext|> y", "a\0 b", "Ünïcode ñ 日本 語", "1 2 3 45 678", "\n", " ", "a\u00a0 b c",
    "of the,\nAnd so. Then:\nÜber alles,\n x a.\nb\nc d!\n e,\nF?", "don't we'll  I'm", "tab\t x y", "é e\u0301 é",
]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path())
    return lambda text: own.encode(text or "", add_special_tokens=False).ids


def test_parts_encode_like_whole_texts(whole, prose, long_text):
    own = token_records.Encoder(tokenizer_path())
    texts = [*ODD, None, "", *(prose(200, i) for i in range(5)), long_text]
    for _ in range(2):  # unknown parts, then known ones
        for text, ids in zip(texts, own.ids(pa.array(texts)), strict=True):
            assert np.frombuffer(ids, own.type).tolist() == whole(text), repr(text)[:50]


def test_round_trip(spark, docs, whole, prose, long_text):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (101, ""), (102, long_text), (103, prose(50, 1)), (103, prose(50, 2)), (104, "x"), (104, "x"), (None, "no id")]
    folder = common.new_folder(spark, "tokens-test")
    manifest = token_records.write(docs(rows), folder, tokenizer_path(), shard_bytes=40_000)
    assert len(manifest) > 1
    found = sorted(token_records.read(spark, folder, manifest).collect(), key=lambda r: r.start)
    # Ascending ids, no id first.
    assert [r.doc_id for r in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    start, texts = 0, {}
    for i, t in rows:
        texts.setdefault(i, []).append(whole(t) + [2])
    for r in found:
        assert r.start == start
        start += r.n_tokens
        sums = [(len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for ids in texts[r.doc_id]]
        assert (r.n_tokens, r.ids_crc32) in sums
    # By the index, in any order.
    shard = manifest[0][0]
    own = [r for r in found if r.shard == shard]
    for place in (len(own) - 1, 0):
        ((doc, ids),) = token_records.read_at(folder, shard, [place])
        assert doc == own[place].doc_id and zlib.crc32(ids.astype("<u4").tobytes()) == own[place].ids_crc32
    common.remove(folder)


def test_distinct_parts_of_many_batches_are_learned_once(whole, prose, monkeypatch):
    own, seen = token_records.Encoder(tokenizer_path()), []
    words = own._words
    monkeypatch.setattr(own, "_words", lambda parts: seen.extend(parts.to_pylist()) or words(parts))
    texts = [f"{prose(30, i)} Ende!!! so%%%\nSo a.b, {i}" for i in range(40)]
    batches = (pa.RecordBatch.from_pydict({"id": [i], "text": [text]}) for i, text in enumerate(texts))
    found = list(token_records.encoded(batches, own))
    assert [(i, np.frombuffer(ids, own.type).tolist()) for i, ids in found] == [(i, whole(text)) for i, text in enumerate(texts)]
    assert len(seen) == len(set(seen)) and {"Ende!!!", "so%%%\nSo"} <= set(seen) and "a.b," not in seen


def test_words_need_a_vocabulary_that_keeps_them_apart():
    letter = token_records._byte_letters()
    line, space = letter[10], letter[32]
    assert not token_records._mixes(["ab", f"{space}ab", ".,", line, f"{space}(", f"{letter[0xE2]}.a"], letter)
    assert all(token_records._mixes([token], letter) for token in ("b.", f"{space}ab,", f"{line}a", f".{line}"))


def test_parts_beyond_those_kept(whole, prose, monkeypatch):
    monkeypatch.setattr(token_records, "_CACHED", 60)
    own = token_records.Encoder(tokenizer_path())
    texts = [*ODD, *(prose(40, i) for i in range(4))]
    for text in (*texts, *texts):
        assert np.frombuffer(own.ids(pa.array([text]))[0], own.type).tolist() == whole(text)
    assert len(own.known) == len(own.known_ids) <= 60


def test_damage_is_found():
    good = token_records.framed(b"first") + token_records.framed(b"second")
    assert [p for _, p in token_records.unframed(io.BytesIO(good))] == [b"first", b"second"]
    for place in range(len(good)):
        bad = bytearray(good)
        bad[place] ^= 4
        with pytest.raises(token_records.Damaged):
            list(token_records.unframed(io.BytesIO(bytes(bad))))
    for cut in range(1, len(good)):
        if cut != len(token_records.framed(b"first")):
            with pytest.raises(token_records.Damaged):
                list(token_records.unframed(io.BytesIO(good[:cut])))


def test_empty_table(spark, docs):
    assert tokens(spark, docs([])).count() == 0
