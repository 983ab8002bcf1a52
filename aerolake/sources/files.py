"""File-system helpers. Every path goes through Spark's Hadoop file systems, so
any scheme that Spark reads works here too (local paths included)."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Files whose header is read at the same time.
HEADER_THREADS = 32


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def is_committed(spark: SparkSession, path: str) -> bool:
    """A table whose write finished (its folder holds the commit marker), or a single file."""
    fs, where = _fs(spark, path), _path(spark, path)
    if not fs.exists(where):
        return False
    return fs.getFileStatus(where).isFile() or fs.exists(_path(spark, f"{path.rstrip('/')}/_SUCCESS"))


def expand_glob(spark: SparkSession, pattern: str) -> list[str]:
    """The files that a path or glob names, wildcards in folder names included, sorted."""
    found = _fs(spark, pattern).globStatus(_path(spark, pattern))
    return sorted(s.getPath().toString() for s in found or [] if s.isFile())


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    """First line of a text file, however long; undecodable bytes raise."""
    jvm = spark._jvm
    decoder = jvm.java.nio.charset.Charset.forName(encoding).newDecoder()
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
        _fs(spark, path).open(_path(spark, path)), decoder))
    try:
        return (reader.readLine() or "").removeprefix("﻿")
    finally:
        reader.close()


def first_lines(spark: SparkSession, paths: Iterable[str], encoding: str = "UTF-8") -> list[str]:
    """First lines of many files; only these lines are read."""
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        return list(pool.map(lambda p: first_line(spark, p, encoding), paths))


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    out = _fs(spark, path).create(_path(spark, path), True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    reader = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(reader.readAllBytes()).decode()
    finally:
        reader.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one; False if there was. The file appears
    whole, under a name of its own first."""
    fs, where = _fs(spark, path), _path(spark, path)
    if fs.exists(where):
        return False
    part = f"{path}.{uuid.uuid4().hex}"
    write_bytes(spark, part, text.encode())
    if fs.exists(where) or not fs.rename(_path(spark, part), where):
        fs.delete(_path(spark, part), False)
        return False
    return True


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, time of change) of the files at or below a path that Spark's
    readers see; hidden ones and those in hidden folders are left out."""
    fs, where = _fs(spark, path), _path(spark, path)
    if not fs.exists(where):
        return []
    out, todo = [], list(fs.listStatus(where))
    while todo:
        status = todo.pop()
        name = status.getPath().getName()
        if name.startswith(".") or name.startswith("_") and "=" not in name:
            continue
        if status.isDirectory():
            todo += list(fs.listStatus(status.getPath()))
        else:
            out.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(out)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path), _path(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(where) if s.isDirectory())


def delete_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)
