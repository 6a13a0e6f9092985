"""WARC files: one gzip member per record, read in sequence with bounded memory.

Of pages with equal payloads, the one with the largest id is written as a response and
the others as revisits that refer to it; a revisit repeats the HTTP head but
not the payload. Payloads under ``least`` bytes are always responses.

A file is read in blocks through an incremental inflater: the head of a member up to its
empty line, then as many bytes as its Content-Length says, which are hashed as they come
and held against the block and payload digests.

Defined results: a null payload is written as an empty one; rows that repeat the largest
id of their payload are all responses; a null id is smaller than any other, is written
without a page header and reads back as null, as does a reference to it; a null
url is written without a target; an empty table writes no file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import batched, opened, publish, rows_of

BLOCK = 1 << 16
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
_UNSAFE = re.compile("[^\x21-\x7e]")


class Damaged(ValueError):
    """A record whose framing or digest is wrong."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _target(url: str) -> str:
    """A header holds no line breaks: everything outside plain ASCII is percent-encoded."""
    return _UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def record(page: int | None, url: str | None, payload: bytes, refers: int | None, revisit: bool) -> bytes:
    """A whole record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {_DATE}"]
    if page is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {_target(url)}")
    if revisit:
        head.append(f"WARC-Profile: {_PROFILE}")
        if refers is not None:
            head.append(f"WARC-Refers-To: <urn:page:{refers}>")
    head += [
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(head).encode() + _END + block + _END) + squeeze.flush()


class Members:
    """The gzip members of a stream, inflated piece by piece."""

    def __init__(self, stream):
        self.stream, self.rest = stream, b""

    def __iter__(self) -> Iterator[Iterator[bytes]]:
        while self.rest or self._more():
            pieces = self._pieces()
            yield pieces
            for _ in pieces:  # what the caller left
                pass

    def _more(self) -> bool:
        self.rest = self.stream.read(BLOCK)
        return bool(self.rest)

    def _pieces(self) -> Iterator[bytes]:
        inflate = zlib.decompressobj(31)
        while not inflate.eof:
            if not self.rest and not self._more():
                raise Damaged("a member ends early")
            try:
                piece = inflate.decompress(self.rest, BLOCK)
            except zlib.error as e:
                raise Damaged(str(e)) from e
            self.rest = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
            if piece:
                yield piece


class Record:
    """One record: its fields, and its block in pieces, checked at its end."""

    def __init__(self, pieces: Iterator[bytes]):
        held = b""
        while _END not in held:
            held += self._next(pieces)
        head, _, self._held = held.partition(_END)
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise Damaged("no WARC version")
        self.fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        self.length, self._pieces = int(self.fields["content-length"]), pieces
        self.http: dict[str, str] = {}
        self.payload_bytes = 0

    @staticmethod
    def _next(pieces: Iterator[bytes]) -> bytes:
        if (piece := next(pieces, None)) is None:
            raise Damaged("a record ends early")
        return piece

    def payload(self) -> Iterator[bytes]:
        """The payload in pieces; raises :class:`Damaged` where it, or the frame, is wrong."""
        block, payload, left = hashlib.sha1(), hashlib.sha1(), self.length
        held, http = self._held, None
        while left or http is None:
            if not held:
                held = self._next(self._pieces)
            piece, held = held[:left], held[left:]
            left -= len(piece)
            block.update(piece)
            if self.http:
                body = piece
            else:
                http = (http or b"") + piece
                if _END not in http:
                    if not left:
                        raise Damaged("no HTTP head")
                    continue
                head, _, body = http.partition(_END)
                self.http = {"": "", **{n.lower(): v.strip() for n, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}}
            if body:
                payload.update(body)
                self.payload_bytes += len(body)
                yield body
        for piece in self._pieces:
            held += piece
        if held != _END:
            raise Damaged("wrong content length")
        revisit = self.fields["warc-type"] == "revisit"
        for found, name in ((block, "warc-block-digest"), *([] if revisit else [(payload, "warc-payload-digest")])):
            if self.fields[name] != "sha1:" + base64.b32encode(found.digest()).decode():
                raise Damaged(f"wrong {name}")

    def page(self, name: str) -> int | None:
        return int(self.fields[name][len("<urn:page:") : -1]) if name in self.fields else None


def records(stream) -> Iterator[Record]:
    for pieces in Members(stream):
        yield Record(pieces)


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> list[str]:
    """Write the pages as WARC files; returns the names of the files."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), html.alias("html")
    ).withColumn("sha", F.sha1(F.col("html").cast("binary")))
    # Largest ids are combined before the shuffle; the join's many side may be split.
    holders = rows.groupBy("sha").agg(F.max("page").alias("holder"))
    found = rows.join(holders, "sha").select("page", "url", "html", "holder")
    kind = pa.schema([("name", pa.string()), ("records", pa.int64())])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, count = f"pages-{TaskContext.get().partitionId():05d}.warc.gz", 0
        rows = rows_of(batches, "page", "url", "html", "holder")
        if (first := next(rows, None)) is None:
            return

        def members() -> Iterator[bytes]:
            yield one(*first)
            for row in rows:
                yield one(*row)

        def one(page: int | None, url: str | None, html: str, holder: int | None) -> bytes:
            nonlocal count
            count += 1
            payload = html.encode()
            return record(page, url, payload, holder, len(payload) >= least and page != holder)

        publish(folder, name, members())
        yield from batched(iter([(name, count)]), kind)

    return sorted(r.name for r in found.mapInArrow(save, "name string, records long").collect())


def read(spark: SparkSession, folder: str, names: list[str], payload: bool = False) -> DataFrame:
    """Read WARC files, a task for each: page_id, payload_bytes, payload_digest,
    record_type, refers_to, url, and the payload if it is asked for."""
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())]
    kind = pa.schema(fields + [("payload", pa.binary())] * payload)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = opened(folder)

        def rows() -> Iterator[tuple]:
            for (name,) in rows_of(batches, "name"):
                with store.open_input_stream(f"{path}/{name}", compression=None, buffer_size=BLOCK) as stream:
                    for one in records(stream):
                        if payload:
                            body = b"".join(one.payload())
                        else:
                            for _ in one.payload():
                                pass
                        of = one.fields
                        yield (
                            one.page("warc-record-id"), int(one.http["content-length"]), of["warc-payload-digest"].removeprefix("sha1:"),
                            of["warc-type"], one.page("warc-refers-to"), of.get("warc-target-uri"), *([body] if payload else []),
                        )

        yield from batched(rows(), kind, 200 if payload else 2000)

    files = spark.createDataFrame([(n,) for n in names], "name string").repartitionByRange(max(1, len(names)), "name")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    return files.mapInArrow(load, schema + ", payload binary" * payload)
