"""Helpers that several operators share."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONF = "spark.checkpoint.dir"


#: Whole texts go to Python in batches of so many rows and bytes at most, so that a
#: worker holds a few MB of them whatever the input.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def small_batches(spark: SparkSession) -> None:
    for name, value in BATCH.items():
        spark.conf.set(name, value)


_held: dict = {}


def held(key: tuple, make: Callable):
    """What a Python worker keeps for its next tasks: the state of one operator at a time,
    so that the operators of a session don't add up."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


_folders: list[str] = []


def _remove_at_end(folder: str) -> None:
    """Checkpoints and stored tables go when Python ends, also after a failure: Spark itself leaves them."""
    if not _folders:
        atexit.register(_remove_all)
    _folders.append(folder)


def _remove_all() -> None:
    while _folders:
        with contextlib.suppress(OSError):
            remove(_folders.pop())


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. A session on one machine
    that names none gets a temporary one; a cluster must name one."""
    folder = spark.conf.get(CONF, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CONF} to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set(CONF, folder)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    # A folder of this application's own in the shared one.
    if (own := spark.sparkContext.getCheckpointDir()) not in _folders:
        _remove_at_end(own)
    return folder


#: Rows of a checkpoint file, where the number of rows is known beforehand.
FILE_ROWS = 50_000


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` stored in the shared folder: its lineage ends there, so a lost
    executor costs a read. ``rows`` is how many it has at most: it is then written by as many tasks as
    that takes, two for each core at least, and not in a small file for every shuffle partition."""
    spark = df.sparkSession
    shared_folder(spark)
    if rows is not None:
        df = df.coalesce(max(2 * spark.sparkContext.defaultParallelism, rows // FILE_ROWS))
    return df.checkpoint(True)


def free_name(df: DataFrame, base: str) -> str:
    """A column name like ``base`` that ``df`` doesn't have."""
    taken, name = {c.lower() for c in df.columns}, f"_{base}"
    while name in taken:
        name = f"_{name}"
    return name


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as a table of the shared folder, and read back. Smaller than a
    checkpoint; who asks for it removes it."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_order(df: DataFrame, out: str) -> DataFrame:
    """``df``, read from files, with a column ``out``: the place of each row, from 0, in the
    order in which the files were written."""
    meta = df.metadataColumn("_metadata")
    file, start = free_name(df, "file"), free_name(df, "start")
    rows = df.select("*", meta["file_path"].alias(file), meta["row_index"].alias(out))
    counts = df.select(meta["file_path"].alias(file)).groupBy(file).count().collect()

    def written(path: str) -> tuple:
        # Spark's names have five digits, and more only where they don't suffice.
        name = path.rsplit("/", 1)[-1]
        part = re.match(r"part-(\d+)", name)
        return int(part[1]) if part else -1, name

    before, starts = 0, []
    for row in sorted(counts, key=lambda r: written(r[file])):
        starts.append((row[file], before))
        before += row["count"]
    # A row for each file.
    starts = F.broadcast(df.sparkSession.createDataFrame(starts, f"{file} string, {start} long"))
    return rows.join(starts, file).withColumn(out, F.col(out) + F.col(start)).drop(file, start)


def new_folder(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _remove_at_end(path)
    return path


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """Any store that Arrow knows by its URI, or a plain path."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def publish(folder: str, name: str, chunks: Iterator[bytes]) -> int:
    """Write a file under a name of its own and then move it to ``name``: a task
    that is run twice leaves one whole file. Returns the bytes written."""
    store, path = opened(folder)
    store.create_dir(path)
    own, size = f"{path}/.{name}.{uuid.uuid4().hex}", 0
    with store.open_output_stream(own) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    store.move(own, f"{path}/{name}")
    return size


def remove(folder: str) -> None:
    store, path = opened(folder)
    if store.get_file_info(path).type != pafs.FileType.NotFound:
        store.delete_dir(path)


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of the columns at hand."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded length."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
