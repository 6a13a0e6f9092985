"""Intermediate tables in the shared folder of the cluster.

A plan that reads one costly input in several branches should read a stored
table. Stored files survive lost executors and cut the lineage. All tables of an
application lie in one folder, which is removed when Python ends, or by :func:`clear`.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_folders: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder of this application under ``spark.checkpoint.dir``. Only a session on
    one machine may have none; it gets a temporary folder."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        folder = spark.conf.get(_CONF, None)
        if not folder:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError(f"set {_CONF} to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        if not _folders:
            atexit.register(_clear_all)
        _folders[app] = f"{folder.rstrip('/')}/ledgerloom-{app}-{uuid.uuid4().hex[:8]}"
    return _folders[app]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new scratch table and return the frame that reads it."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_all(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """:func:`stage` for several frames at once, by label: a table of a few tasks leaves most cores idle."""
    with ThreadPoolExecutor(max(1, len(frames))) as pool:
        return dict(zip(frames, pool.map(stage, frames.values(), frames), strict=True))


def clear(spark: SparkSession) -> None:
    """Remove the scratch tables of this application; frames that read them end here."""
    if folder := _folders.pop(spark.sparkContext.applicationId, None):
        _remove(folder)


def _clear_all() -> None:
    while _folders:
        _remove(_folders.popitem()[1])


def _remove(folder: str) -> None:
    store, path = fs.FileSystem.from_uri("/" + folder.removeprefix("file:").lstrip("/") if folder.startswith("file:") else folder)
    if store.get_file_info(path).type != fs.FileType.NotFound:
        store.delete_dir(path)
