"""Small files and folders in any store that Spark reads."""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote, urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Exists(Exception):
    """The name is taken."""


def decoded(uri: str) -> str:
    """The path that a ``_metadata.file_path`` stands for."""
    parts = urlsplit(uri)
    if not parts.scheme:
        return unquote(uri)
    host = f"//{parts.netloc}" if parts.netloc else ""
    return f"{parts.scheme}:{host}{unquote(uri.split(':', 1)[1][len(host) :])}"


def literal(path: str) -> str:
    """``path`` for a reader that takes glob patterns: it stands for itself only."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


class Store:
    """The file system of one path, by way of Spark's own."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._jvm = spark._jvm
        self._fs = self._path(path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def names(self, folder: str) -> list[str]:
        """What a folder holds; nothing if there is no such folder."""
        try:
            found = self._fs.listStatus(self._path(folder))
        except Py4JJavaError as error:
            if "FileNotFoundException" in error.java_exception.getClass().getName():
                return []
            raise
        return sorted(x.getPath().getName() for x in found)

    def text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def put_new(self, path: str, text: str) -> None:
        """Write a file that is there whole or not at all; :class:`Exists` if the name is taken."""
        folder, name = path.rsplit("/", 1)
        own = f"{folder}/.{name}.{uuid.uuid4().hex}"
        self._fs.mkdirs(self._path(folder))
        self._write(own, text)
        try:
            context = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf)
            kind = self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
            context.rename(self._path(own), self._path(path), self._jvm.java.lang.reflect.Array.newInstance(kind, 0))
        except Py4JJavaError as error:
            self.remove(own)
            told = error.java_exception.getClass().getName()
            if "FileAlreadyExists" in told:
                raise Exists(path) from error
            if "UnsupportedFileSystem" not in told:
                raise
            self._write(path, text)  # a store without renames, where a small file appears at once

    def _write(self, path: str, text: str) -> None:
        try:
            out = self._fs.create(self._path(path), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise Exists(path) from error
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
