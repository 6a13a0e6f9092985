"""Token ids as length-delimited binary records, with an offset index.

One record of a shard file, all numbers little-endian::

    uint64 length of the payload
    uint32 masked checksum of those 8 bytes
    payload: uint8 1 if there is a document id, int64 document id (0 if none),
             then the ids, 2 bytes each where the vocabulary allows, else 4
    uint32 masked checksum of the payload

The checksum is CRC-32, masked as ``rotate right by 15, plus 0xA282EAD8``: a checksum
of data that itself holds checksums stays strong. ``shard-00000.bin`` has an index
``shard-00000.idx`` of 24-byte rows (int64 document id, uint64 offset, uint64 number
of ids), so a shuffled reader can seek to any record. Where the rows have a place in an
order of their own, such as a mix, ``shard-00000.pos`` holds it as an int64 a record: who
reads the records by it, with the index, gets that order.

Defined results: a null or empty text is a record of the end id alone; a null document
id sorts first and reads back as null; rows with one document id are ordered by
their text, and repeated rows stay; an empty table makes no shard.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batched, held, opened, publish, rows_of

END_ID = 2
SHARD_BYTES = 16 << 20
# Cut points of a text are single spaces between two non-space characters. A
# byte-level pre-tokenizer always begins a new piece there, so the parts can be
# encoded one by one; texts with other spacing are encoded whole.
_SPACES = r"\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_IRREGULAR = rf"[{_SPACES}] | [{_SPACES}]|^ | $|<\|"
# Latin letters, perhaps with signs, and perhaps more after a line break: the
# pre-tokenizer keeps letters together, signs together and the break apart. A sign
# before letters or an apostrophe may belong to them, so there is none.
_LETTERS, _SIGNS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"!-&(-/:-@\[-`{-~"
_WORDS = f"^[{_LETTERS}]+[{_SIGNS}]*(\n[{_LETTERS}]+[{_SIGNS}]*)?$"
_CACHED = 300_000
_TEXT_BYTES = 8 << 20
_HEAD, _SUM, _ID, _ROW = "<Q", "<I", "<Bq", "<qQQ"


class Damaged(ValueError):
    """A record whose checksum or length is wrong."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    head = struct.pack(_HEAD, len(payload))
    return b"".join((head, struct.pack(_SUM, masked(head)), payload, struct.pack(_SUM, masked(payload))))


def unframed(stream) -> Iterator[tuple[int, bytes]]:
    """(offset, payload) of each record of a stream; raises :class:`Damaged`."""
    offset = 0
    while head := stream.read(12):
        if len(head) < 12 or masked(head[:8]) != struct.unpack_from(_SUM, head, 8)[0]:
            raise Damaged(f"length at byte {offset}")
        size = struct.unpack_from(_HEAD, head)[0]
        body = stream.read(size + 4)
        if len(body) < size + 4 or masked(body[:size]) != struct.unpack_from(_SUM, body, size)[0]:
            raise Damaged(f"payload at byte {offset}")
        yield offset, body[:size]
        offset += size + 16


def _byte_letters() -> dict[int, str]:
    """How a byte-level vocabulary writes bytes: printable ones as they are, the others
    as the letters from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _mixes(vocabulary: Iterable[str], letter: dict[int, str]) -> bool:
    """Whether a token joins what the pre-tokenizer keeps apart in :data:`_WORDS`."""
    letters = "A-Za-z" + "".join(letter[b] for b in (*range(0x80, 0xC0), *range(0xC3, 0xCA)))
    line = letter[10]
    own = f"[{letters}{_SIGNS}{line}{letter[32]}]*"
    joint = f"[{letters}][{_SIGNS}{line}]|[{_SIGNS}]{line}|{line}[{letters}]"
    return any(map(re.compile(f"{own}(?:{joint}){own}").fullmatch, vocabulary))


class Encoder:
    """Texts to bytes of ids. Parts of texts between single spaces repeat, so the ids of
    distinct parts are found, and those of a bounded number of parts are kept."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.model, self.bytes_as_letters = self.tokenizer.model, _byte_letters()
        self.separate = not _mixes(self.tokenizer.get_vocab(with_added_tokens=False), self.bytes_as_letters)
        self.known, self.known_ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type).tobytes()

    def _packed(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The ids up to each end as the bytes of a value."""
        offsets = np.concatenate(([0], ends)).astype(np.int64) * self.type.itemsize
        data = pa.py_buffer(np.ascontiguousarray(ids, self.type))
        return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), data])

    def _others(self, parts: list[str]) -> pa.Array:
        """Parts, each after a space, are encoded many in one text and told apart by the
        places of their tokens."""
        parts, out = [f" {part}" for part in parts], [pa.array([], pa.large_binary())]
        for at in range(0, len(parts), 2000):
            some = parts[at : at + 2000]
            found = self.tokenizer.encode("".join(some), add_special_tokens=False)
            ends = np.cumsum([len(part) for part in some])
            starts = np.array([start for start, _ in found.offsets], np.int64)
            out.append(self._packed(np.array(found.ids, self.type), np.searchsorted(starts, ends)))
        return pa.concat_arrays(out)

    def _words(self, parts: pa.Array) -> pa.Array:
        """Parts that are words, each after a space: merged by the model without the steps
        before it, as no token joins letters, signs and breaks."""
        out, space = [pa.array([], pa.large_binary())], self.bytes_as_letters[32]
        for at in range(0, len(parts), 2000):
            some = parts.slice(at, 2000)
            listed = pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some)
            letters = pc.binary_join(listed, " ")[0].as_py().encode().decode("latin-1").translate(self.bytes_as_letters)
            tokens = [self.model.tokenize(space + part) for part in letters.split(space)]
            ids = np.fromiter(map(attrgetter("id"), chain.from_iterable(tokens)), self.type)
            out.append(self._packed(ids, np.cumsum(list(map(len, tokens)))))
        return pa.concat_arrays(out)

    def _known_or_learned(self, parts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Ids, and the place of each part's among them."""
        place = pc.index_in(parts, value_set=self.known)
        new = parts.filter(place.is_null())
        words = pc.match_substring_regex(new, _WORDS) if self.separate else pa.array(np.zeros(len(new), bool))
        # Learned in the order words, others.
        new = [new.filter(words), new.filter(pc.invert(words))]
        ids = pa.concat_arrays([self.known_ids, self._words(new[0]), self._others(new[1].to_pylist())])
        at = place.fill_null(-1).to_numpy().astype(np.int64)
        is_word, gaps = words.to_numpy(zero_copy_only=False), np.flatnonzero(at < 0)
        at[gaps[is_word]] = len(self.known) + np.arange(len(new[0]))
        at[gaps[~is_word]] = len(self.known) + len(new[0]) + np.arange(len(new[1]))
        if len(ids) <= _CACHED:
            self.known, self.known_ids = pa.concat_arrays([self.known, *new]), ids
        return ids, at

    def ids(self, texts: pa.Array) -> list[bytes]:
        """The ids of each of a bounded number of texts. Arrow splits the texts, finds the
        distinct parts and puts their ids together again."""
        texts = texts.cast(pa.string())
        listed, filled = texts.to_pylist(), pc.fill_null(texts, "")
        odd = pc.match_substring_regex(filled, _IRREGULAR)
        plain, odd = pc.if_else(odd, "", filled), odd.to_pylist()
        split = pc.split_pattern(plain, " ")
        offsets = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        ids, at = self._known_or_learned(coded.dictionary)
        index = at[coded.indices.to_numpy()]
        # The first part of a text has no space before it.
        firsts = [self.whole(t.partition(" ")[0]) if t and not o else b"" for t, o in zip(listed, odd, strict=True)]
        index[offsets[:-1]] = len(ids) + np.arange(len(firsts))
        joined = pa.concat_arrays([ids, pa.array(firsts, pa.large_binary())]).take(pa.array(index))
        at = np.frombuffer(joined.buffers()[1], np.int64)[offsets].tolist()
        data = joined.buffers()[2].to_pybytes() if joined.buffers()[2] else b""
        return [self.whole(t) if o else data[a:b] for t, o, (a, b) in zip(listed, odd, pairwise(at), strict=True)]


def encoder(path: str) -> Encoder:
    """One for each Python worker: what it learned serves the next tasks."""
    return held(("encoder", path), lambda: Encoder(path))


def encoded(batches: Iterator[pa.RecordBatch], own: Encoder) -> Iterator[tuple[int | None, bytes]]:
    """Batches of some MB together, as the texts of more rows have fewer distinct parts."""

    def coded(some: list[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
        rows = pa.Table.from_batches(some).combine_chunks()
        for batch in rows.to_batches():
            yield from zip(batch.column("id").to_pylist(), own.ids(batch.column("text")), strict=True)

    some, size = [], 0
    for batch in batches:
        some.append(batch)
        size += batch.nbytes
        if size >= _TEXT_BYTES:
            yield from coded(some)
            some, size = [], 0
    if some:
        yield from coded(some)


def shard_name(shard: int, kind: str = "bin") -> str:
    return f"shard-{shard:05d}.{kind}"


def write(
    docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    shard_bytes: int = SHARD_BYTES, end_id: int = END_ID, position_col: str | None = None,
) -> list[tuple[int, int, int]]:
    """Encode and write the shards, in ascending order of ids across them, and the
    rows' places in ``position_col`` beside them if there is one.
    Returns the manifest: (shard, documents, ids), a row for each shard."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        *([F.col(position_col).cast("long").alias("position")] if position_col else []),
    )
    size = rows.agg(F.sum(F.octet_length("text") + F.lit(64))).first()[0] or 0
    parts = max(1, -(-size // shard_bytes))
    tie = F.xxhash64("text")
    # The range partitions are the shards. The hash spreads rows of one id, and
    # keeps whole texts out of the sample of the range bounds.
    dealt = rows.repartitionByRange(int(parts), "id", tie).sortWithinPartitions("id", tie, "text", *rows.columns[2:])
    manifest = pa.schema([("shard", pa.int64()), ("documents", pa.int64()), ("ids", pa.int64())])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, own = TaskContext.get().partitionId(), encoder(tokenizer)
        end, index, total, places = np.array([end_id], own.type).tobytes(), bytearray(), [0, 0, 0], bytearray()

        def placed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if position_col:
                    places.extend(batch.column("position").to_numpy().astype("<i8").tobytes())
                yield batch

        def records() -> Iterator[bytes]:
            for doc, ids in encoded(placed(), own):
                ids += end
                record = framed(struct.pack(_ID, doc is not None, doc or 0) + ids)
                count = len(ids) // own.type.itemsize
                index.extend(struct.pack(_ROW, doc or 0, total[2], count))
                total[0] += 1
                total[1] += count
                total[2] += len(record)
                yield record

        publish(folder, shard_name(shard), records())
        publish(folder, shard_name(shard, "idx"), iter([bytes(index)]))
        if position_col:
            publish(folder, shard_name(shard, "pos"), iter([bytes(places)]))
        yield from batched(iter([(shard, total[0], total[1])]), manifest)

    found = dealt.mapInArrow(save, "shard long, documents long, ids long").collect()
    return sorted((r.shard, r.documents, r.ids) for r in found if r.documents)


def read(spark, folder: str, manifest: list[tuple[int, int, int]], width: int = 2, positions: bool = False) -> DataFrame:
    """Read the shards back, a task for each: doc_id, start, n_tokens, ids_crc32, shard, offset,
    and position if they were written with it."""
    starts, at = {}, 0
    for shard, _, ids in manifest:
        starts[shard], at = at, at + ids
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, shard long, offset long"
    names = ("doc_id", "start", "n_tokens", "ids_crc32", "shard", "offset")
    if positions:
        schema, names = f"{schema}, position long", (*names, "position")
    arrow = pa.schema([(n, pa.int64()) for n in names])

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = opened(folder)

        def rows() -> Iterator[tuple]:
            for (shard,) in rows_of(batches, "shard"):
                start, places = starts[shard], repeat(())
                if positions:
                    with store.open_input_file(f"{path}/{shard_name(shard, 'pos')}") as file:
                        places = zip(np.frombuffer(file.read(), "<i8").tolist(), strict=True)
                with store.open_input_stream(f"{path}/{shard_name(shard)}", buffer_size=1 << 20) as stream:
                    for (offset, payload), place in zip(unframed(stream), places, strict=positions):
                        known, doc = struct.unpack_from(_ID, payload)
                        ids = np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(_ID)).astype("<u4")
                        yield doc if known else None, start, len(ids), zlib.crc32(ids.tobytes()), shard, offset, *place
                        start += len(ids)

        yield from batched(rows(), arrow)

    shards = spark.createDataFrame([(s,) for s in starts] or [], "shard long")
    return shards.repartitionByRange(max(1, len(starts)), "shard").mapInArrow(load, schema)


def read_at(folder: str, shard: int, rows: list[int], width: int = 2) -> list[tuple[int | None, np.ndarray]]:
    """Records of a shard by their place in its index, in any order."""
    store, path = opened(folder)
    with store.open_input_file(f"{path}/{shard_name(shard, 'idx')}") as file:
        index = file.read()
    out = []
    with store.open_input_file(f"{path}/{shard_name(shard)}") as file:
        for row in rows:
            file.seek(struct.unpack_from(_ROW, index, row * struct.calcsize(_ROW))[1])
            _, payload = next(unframed(file))
            known, doc = struct.unpack_from(_ID, payload)
            out.append((doc if known else None, np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(_ID))))
    return out


def width_of(tokenizer: str) -> int:
    return encoder(tokenizer).type.itemsize
