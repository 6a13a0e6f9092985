"""Stored datasets: by catalog name or by path, in any installed format.

An overwrite never touches what is stored. It writes a version folder of its own; when that
is whole, a small pointer file with the next number is put beside the older ones, and
readers go by the pointer with the largest number. So a job that fails leaves the old
rows, a dataset may be overwritten from itself, and readers that have resolved a pointer
go on with their version, as the last ``KEPT`` ones stay. Two writers that start from
the same version get the same number: the second one fails.

A catalog table is an external table whose location is the version folder; an overwrite
moves the location. Formats that keep versions of their own (``delta`` and the like) are
left to them. A catalog table may be stored in buckets of a key: joins and aggregates on
the key then need no shuffle, as long as both sides have the same number of buckets.

A dataset may be stored in global order: its files are the parts of that order, and the
pointer has the number of rows of each, so that the first rows are read from the first files.

    <target>/_versions/00000007-<id>/part-...   the rows
    <target>/_current/00000007                  which folder, its format, what it was made of
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.files import Exists, Store, decoded, literal

KEPT = 2
OWN_VERSIONS = ("delta", "iceberg", "hudi")


class Conflict(RuntimeError):
    """Someone else overwrote the dataset meanwhile."""


class Version(NamedTuple):
    number: int
    path: str
    fmt: str
    mark: str | None  # what the writer says the rows were made of
    order: tuple[str, ...] = ()
    parts: tuple[tuple[str, int], ...] = ()  # file and rows, in that order


def _is_path(target: str) -> bool:
    return "/" in target


def _folder(spark: SparkSession, target: str) -> str:
    """Where the versions of a dataset lie."""
    if _is_path(target):
        return target.rstrip("/")
    *database, table = target.split(".")
    place = spark.catalog.getDatabase(database[0] if database else spark.catalog.currentDatabase())
    return f"{decoded(place.locationUri).rstrip('/')}/{table}.stored"


def versions(spark: SparkSession, target: str) -> list[Version]:
    """The versions at hand, the current one last."""
    folder = _folder(spark, target)
    files, found = Store(spark, folder), []
    for name in files.names(f"{folder}/_current"):
        if name.isdigit():
            told = json.loads(files.text(f"{folder}/_current/{name}"))
            place, parts = f"{folder}/_versions/{told['folder']}", tuple(map(tuple, told.get("parts", ())))
            found.append(Version(int(name), place, told["format"], told.get("mark"), tuple(told.get("order", ())), parts))
    return sorted(found)


def current(spark: SparkSession, target: str) -> Version | None:
    found = versions(spark, target)
    return found[-1] if found else None


def read_table(spark: SparkSession, target: str, fmt: str = "parquet", number: int | None = None) -> DataFrame:
    """The current rows, or those of an older version. ``fmt`` is for paths that were not
    written by :func:`store`, which remembers the format."""
    if number is not None:
        return _load(spark, next(v for v in versions(spark, target) if v.number == number))
    if not _is_path(target):
        _finish_move(spark, target)
        return spark.read.table(target)
    if fmt not in OWN_VERSIONS and (version := current(spark, target)):
        return _load(spark, version)
    return spark.read.format(fmt).load(target)


def _load(spark: SparkSession, version: Version) -> DataFrame:
    return spark.read.format(version.fmt).load(literal(version.path))


def _ordering(order: Sequence[str]) -> list[Column]:
    """``-name`` is descending. NULL is last."""
    return [F.col(f"`{c[1:]}`").desc_nulls_last() if c.startswith("-") else F.col(f"`{c}`").asc_nulls_last() for c in order]


def head(spark: SparkSession, target: str, k: int) -> DataFrame:
    """The first ``k`` rows of a dataset that is stored in order, from as many files as that takes."""
    version = current(spark, target)
    if version is None or not version.order:
        raise ValueError(f"{target} is not stored in order")
    files, rows = [], 0
    for name, n in version.parts:
        files.append(literal(f"{version.path}/{name}"))
        rows += n
        if rows >= k:
            break
    schema = _load(spark, version).schema
    found = spark.read.format(version.fmt).schema(schema).load(files) if files else spark.createDataFrame([], schema)
    return found.orderBy(*_ordering(version.order)).limit(k)


class Buckets(NamedTuple):
    number: int
    key: str


def store(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    mark: str | None = None,
    kept: int = KEPT,
    buckets: Buckets | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Replace what is stored at a path, or under a name, and return the frame that reads it
    back. ``mark`` is kept with the version; ``kept`` versions stay. ``buckets`` are for names only; a key
    with a large part of the rows makes one large bucket. ``order`` has the columns of a global order,
    ``-name`` for a descending one, for :func:`head`."""
    spark = df.sparkSession
    if fmt in OWN_VERSIONS or target.count(".") > 1 and not _is_path(target):
        return _left_to_format(df, target, fmt)
    if _is_path(target):
        return _load(spark, _written(df, _folder(spark, target), fmt, mark, kept, order=order))
    _finish_move(spark, target)
    spark.sql(f"DROP TABLE IF EXISTS {_next(target)}")
    _point(df, target, _written(df, _folder(spark, target), fmt, mark, kept, buckets, _next(target), order), buckets)
    return spark.read.table(target)


def write_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Store as a catalog table, replacing what is there."""
    store(df, name, fmt)


def write_path(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Store as files under a path, replacing what is there."""
    store(df, path, fmt)


def _left_to_format(df: DataFrame, target: str, fmt: str) -> DataFrame:
    if _is_path(target):
        df.write.format(fmt).mode("overwrite").save(target)
        return df.sparkSession.read.format(fmt).load(target)
    df.writeTo(target).using(fmt).createOrReplace()
    return df.sparkSession.read.table(target)


def _written(
    df: DataFrame, folder: str, fmt: str, mark: str | None, kept: int, buckets: Buckets | None = None, table: str = "",
    order: Sequence[str] = (),
) -> Version:
    """A new version of the rows; with ``buckets`` it is registered as ``table``, too."""
    spark = df.sparkSession
    files, before = Store(spark, folder), versions(spark, folder)
    number = before[-1].number + 1 if before else 1
    name = f"{number:08d}-{uuid.uuid4().hex}"
    version = Version(number, f"{folder}/_versions/{name}", fmt, mark, tuple(order))
    try:
        if buckets:
            # Dealt out like the buckets, so that each is one file.
            writer = df.repartition(*buckets).write.format(fmt).bucketBy(*buckets).sortBy(buckets.key)
            writer.option("path", version.path).saveAsTable(table)
        else:
            (df.orderBy(*_ordering(order)) if order else df).write.format(fmt).save(version.path)
        told = {"folder": name, "format": fmt, "mark": mark}
        if order:
            told |= {"order": list(order), "parts": _parts(_load(spark, version))}
        files.put_new(f"{folder}/_current/{number:08d}", json.dumps(told))
    except Exists as error:
        files.remove(version.path)
        raise Conflict(f"{folder} was overwritten meanwhile") from error
    except BaseException:
        files.remove(version.path)
        raise
    _prune(files, folder, [*before, version][-max(kept, 1) :])
    return version


def _parts(stored: DataFrame) -> list[tuple[str, int]]:
    """The files of a sort and their rows, in order: Spark numbers them."""
    counts = stored.groupBy(stored.metadataColumn("_metadata")["file_name"].alias("name")).count().collect()
    return sorted(((r["name"], r["count"]) for r in counts), key=lambda r: (int(re.match(r"part-(\d+)", r[0])[1]), r[0]))


def _prune(files: Store, folder: str, kept: list[Version]) -> None:
    """Drop pointers and folders older than the ``kept`` ones, leavings of broken runs and
    files from before there were versions."""
    first, known = kept[0].number, {v.path.rsplit("/", 1)[1] for v in kept}
    for name in files.names(f"{folder}/_current"):
        if name.isdigit() and int(name) < first:
            files.remove(f"{folder}/_current/{name}")
    for name in files.names(f"{folder}/_versions"):
        # A writer at work, even one that will find its number taken, has none below the current one.
        if name not in known and int(name.split("-")[0]) < kept[-1].number:
            files.remove(f"{folder}/_versions/{name}")
    for name in files.names(folder):
        if name not in ("_current", "_versions"):
            files.remove(f"{folder}/{name}")


def _next(name: str) -> str:
    return f"{name}__next"


def _point(df: DataFrame, name: str, version: Version, buckets: Buckets | None) -> None:
    """Let the catalog table read a version. Where its columns, its format or its buckets change, a new
    table takes its place; if that is broken off between the two steps, the next reader or
    writer finishes it."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name) and _layout(spark, name) == _wanted(df, version.fmt, buckets):
        place = version.path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
        spark.sql(f"DROP TABLE IF EXISTS {_next(name)}")
        return
    if not buckets:
        spark.catalog.createTable(_next(name), path=version.path, source=version.fmt, schema=df.schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _finish_move(spark, name)


def _finish_move(spark: SparkSession, name: str) -> None:
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(_next(name)):
        spark.sql(f"ALTER TABLE {_next(name)} RENAME TO {name}")


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def _wanted(df: DataFrame, fmt: str, buckets: Buckets | None) -> tuple:
    return _columns(df), fmt, str(buckets.number if buckets else 0), f"[`{buckets.key}`]" if buckets else "[]"


def _layout(spark: SparkSession, name: str) -> tuple:
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    buckets = told.get("Num Buckets", "0"), told.get("Bucket Columns", "[]")
    return _columns(spark.read.table(name)), told.get("Provider", "").lower(), *buckets
