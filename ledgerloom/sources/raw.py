"""Raw files: CSV directories to frames with canonical column names."""

from __future__ import annotations

import csv
import hashlib
import warnings
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.model import Entity
from ledgerloom.sources.files import decoded, literal

_BOM = "\ufeff"


def read_raw(
    spark: SparkSession,
    entity: Entity,
    path: str,
    glob: str | None = None,
    header_names: list[str] | None = None,
) -> DataFrame:
    """All files of an entity under ``path``, every column as text, by name.

    Columns are matched by header name, file by file. One job reads the files as lines and
    takes the first one of each (:func:`headers`); files with one header are then one scan. With
    ``header_names`` (the raw header, in file order) no job runs before the data is read; a file
    with another header then fails that job. No type is inferred: dirty values would be rejected.
    Columns under names that the entity does not know are left out with a warning, see
    :func:`unknown_columns`.
    """
    if header_names:
        reader = _with_header(spark, header_names).option("pathGlobFilter", glob or entity.glob)
        return conform(reader.load(path), entity)
    files, mark = headers(spark, path, glob or entity.glob)
    frames = [conform(_load(spark, line, paths), entity) for line, paths in sorted(files.items())]
    if not frames:
        return conform(spark.createDataFrame([], ", ".join(f"{c} string" for c in entity.columns)), entity)
    absent = set.intersection(*map(absent_columns, frames))
    unknown = set.union(*map(unknown_columns, frames))
    if unknown:
        warnings.warn(f"{entity.name}: no use for the columns {sorted(unknown)}", stacklevel=2)
    return _marked(reduce(DataFrame.unionByName, frames), absent, unknown, mark)


def headers(spark: SparkSession, path: str, glob: str) -> tuple[dict[str, list[str]], str]:
    """The files under ``path`` by their first line that is not blank, and a digest of their names,
    sizes and times. One job, whatever the number of files: only the task that has the
    start of a file looks for its first line. The driver holds a row for each file, as
    does any scan of them. Files without lines are left out."""
    lines = spark.read.format("text").option("pathGlobFilter", glob).load(path)
    # The reader knows the file of a line by these columns of its own.
    lines = lines.selectExpr(
        "CASE WHEN trim(value) <> '' THEN value END AS line", "_metadata.file_path AS path",
        "_metadata.file_block_start AS start", "_metadata.file_size AS size", "_metadata.file_modification_time AS time",
    )
    # A block is read by one task and in order, so its first line is the first of one partial result.
    first = lines.where("start = 0").groupBy("path", "start", "size", "time").agg(F.first("line", ignorenulls=True).alias("line"))
    found: dict[str, list[str]] = {}
    digest = hashlib.sha256()
    for row in sorted(first.selectExpr("path", "size", "unix_micros(time) AS time", "line").collect()):
        digest.update(repr((row.path, row.size, row.time)).encode())
        if row.line is not None:
            found.setdefault(row.line, []).append(decoded(row.path))
    return found, digest.hexdigest()


def _load(spark: SparkSession, line: str, paths: list[str]) -> DataFrame:
    """The files that begin with the header ``line``."""
    own = next(csv.reader([line], escapechar="\\"))
    names = [n.removeprefix(_BOM).strip() for n in own]
    paths = [literal(p) for p in paths]
    if len({n.lower() for n in own}) == len(own) and names == own and "" not in names:
        return _with_header(spark, names).load(paths)
    # By place: a padded, repeated or empty name is none that Spark would check.
    placed = _with_header(spark, [f"c{i}" for i in range(len(names))]).option("enforceSchema", True).load(paths)
    return placed.toDF(*names)


def _with_header(spark: SparkSession, names: Iterable[str]):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.format("csv").schema(schema).option("header", True).option("enforceSchema", False)


def conform(df: DataFrame, entity: Entity, keep: tuple[str, ...] = ()) -> DataFrame:
    """Select the entity's columns as text under their canonical names.

    Known raw spellings are renamed, and columns named in ``keep`` (load order marks
    and the like) stay unchanged. Columns the source lacks become NULL and are
    marked, see :func:`absent_columns`. Two raw columns of one name are an error.
    """
    present: dict[str, int] = {}
    unknown = set()
    for place, name in enumerate(df.columns):
        known = name.removeprefix(_BOM).strip().lower()
        known = entity.aliases.get(known, known)
        if known not in entity.columns:
            unknown |= {name.strip()} - {*keep, ""}
        elif known in present:
            raise ValueError(f"{entity.name}: both {df.columns[present[known]]!r} and {name!r} are {known}")
        else:
            present[known] = place
    # By place: a raw name may come twice, as long as it is not one that is used.
    raw = df.toDF(*(f"_{i}" if n not in keep else n for i, n in enumerate(df.columns)))
    canonical = [
        (F.col(f"_{present[c]}").cast("string") if c in present else F.lit(None).cast("string")).alias(c)
        for c in entity.columns
    ]
    return _marked(raw.select(*canonical, *keep), {c for c in entity.columns if c not in present}, unknown)


def _marked(df: DataFrame, absent: set[str], unknown: set[str], mark: str | None = None) -> DataFrame:
    """What is known of the source is metadata of the columns."""
    told = {c: {"absent": True} if c in absent else {} for c in df.columns}
    told[df.columns[0]] |= {"unknown": sorted(unknown)} | ({"mark": mark} if mark else {})
    return df.select(*(F.col(c).alias(c, metadata=told[c]) for c in df.columns))


def absent_columns(df: DataFrame) -> set[str]:
    """The columns that no source of a conformed frame has."""
    return {f.name for f in df.schema.fields if f.metadata.get("absent")}


def unknown_columns(df: DataFrame) -> set[str]:
    """The columns of the source that a conformed frame left out."""
    return {name for f in df.schema.fields for name in f.metadata.get("unknown", ())}


def source_mark(df: DataFrame) -> str:
    """A digest that changes with the rows of a source: that of its files where
    :func:`read_raw` made it, else one of all rows, in any order, which reads them."""
    for f in df.schema.fields:
        if "mark" in f.metadata:
            return f.metadata["mark"]
    row = F.xxhash64(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"}))
    found = df.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.sum(F.xxhash64(row).cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr((df.dtypes, *map(str, found))).encode()).hexdigest()
